"""Column-expression helpers (JVM-side built-ins only, no Python UDFs)."""

from pricelake.functions.dates import (  # noqa: F401
    CSV_DATE_FORMAT,
    PROVIDER_DATE_FORMAT,
    format_csv_date,
    format_provider_date,
    parse_date,
    weekday_mon0,
)
from pricelake.functions.numeric import (  # noqa: F401
    inverse_minmax,
    is_missing,
    log1p_or_null,
    ln_or_null,
    minmax,
    order_image,
)
from pricelake.functions.strings import flatten_label, normalize_label  # noqa: F401
