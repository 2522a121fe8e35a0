"""Column-level helpers: window frames, null-safe math, formatting."""

from quiver.functions.scalar import (  # noqa: F401
    clip_keep_null,
    normal_cdf,
    round6,
    safe_div,
    safe_ln,
)
from quiver.functions.windows import (  # noqa: F401
    expanding,
    guarded,
    rolling_mean,
    rolling_std,
    rolling_sum,
    series_window,
    trailing,
)
