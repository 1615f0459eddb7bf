from waitlens.plans.stored import plan_rows, plan_table, register_functions, render, render_first, with_tree

__all__ = ["plan_rows", "plan_table", "register_functions", "render", "render_first", "with_tree"]
