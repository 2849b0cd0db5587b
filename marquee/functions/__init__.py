"""Column-level helpers built only from ``pyspark.sql.functions``."""

from marquee.functions.scalar import (  # noqa: F401
    ACTOR_STAGE, DIRECTOR_STAGE, PERSON_TIER, RATING_CATEGORY, ROLE_TYPE,
    age, band, csv_contains, decade, decode_gender, human_count, null_tokens,
    safe_int, token_estimate, trim_ws)
from marquee.functions.numeric import MEAN_TYPE, exact_mean, int_div, rounded_share  # noqa: F401
