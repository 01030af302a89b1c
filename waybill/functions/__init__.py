from waybill.functions.dates import (
    boundary_diff,
    lenient_date,
    lenient_timestamp,
    monday_bucket,
    month_end,
    quarter_start,
)
from waybill.functions.numbers import (
    log_choose,
    log_factorial,
    logistic,
    logit,
    round6,
    safe_ratio,
)
from waybill.functions.places import density, haversine
from waybill.functions.text import change_value, parse_money, slug, strip_quotes, truthy, same_text
from waybill.functions.tails import chi2_sf, digamma, log_gamma, normal_cdf, normal_two_sided, trigamma, upper_gamma

__all__ = [
    "boundary_diff",
    "change_value",
    "chi2_sf",
    "density",
    "haversine",
    "lenient_date",
    "lenient_timestamp",
    "log_choose",
    "log_factorial",
    "logistic",
    "logit",
    "monday_bucket",
    "month_end",
    "digamma",
    "log_gamma",
    "normal_cdf",
    "normal_two_sided",
    "trigamma",
    "upper_gamma",
    "parse_money",
    "quarter_start",
    "round6",
    "safe_ratio",
    "same_text",
    "slug",
    "strip_quotes",
    "truthy",
]
