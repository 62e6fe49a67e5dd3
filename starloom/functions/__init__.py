"""Column-level functions (all built from pyspark.sql.functions, no UDFs)."""

from starloom.functions.text import (  # noqa: F401
    NOT_PROVIDED, blank_to_not_provided, clean_text, punct_to_space, strip_unicode,
)
from starloom.functions.numbers import (  # noqa: F401
    is_whole, parse_double, parse_long, round_half_even_long,
)
from starloom.functions.dates import (  # noqa: F401
    DEFAULT_DATE_FORMATS, date_key, full_date_description, is_weekday,
    parse_order_date, to_day,
)
