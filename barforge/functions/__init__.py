from barforge.functions.core import (  # noqa: F401
    clamp,
    greatest_strict,
    least_strict,
    r,
    running,
    safe_div,
    sign_long,
    sunday_week,
    symbol_window,
    trailing,
    u01,
)
