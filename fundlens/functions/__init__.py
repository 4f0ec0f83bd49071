from fundlens.functions.dates import business_day_spine, iso_date, is_weekday, parse_date
from fundlens.functions.exact import millions, round_ratio, sum_exact
from fundlens.functions.numeric import money_product, parse_decimal, sign_class
from fundlens.functions.priority import SOURCE_PRIORITY, source_priority
from fundlens.functions.text import (
    NA,
    NOT_RATED,
    UNDEFINED_MATURITY,
    fund_short_name,
    issuer_short_name,
    lookup,
    rating_bucket,
    truncate,
    with_placeholder,
)

__all__ = [
    "business_day_spine", "iso_date", "is_weekday", "parse_date",
    "millions", "round_ratio", "sum_exact",
    "money_product", "parse_decimal", "sign_class",
    "SOURCE_PRIORITY", "source_priority",
    "NA", "NOT_RATED", "UNDEFINED_MATURITY", "fund_short_name", "issuer_short_name",
    "lookup", "rating_bucket", "truncate", "with_placeholder",
]
