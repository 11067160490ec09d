from .scalar import (  # noqa: F401
    age_years,
    avg_toi_seconds,
    cast_id,
    first_word,
    full_name,
    goalie_percentage,
    localized_default,
    minutes_part,
    name_link,
    result_line,
    save_percentage,
    second_word,
    seconds_part,
    toi_seconds,
)
from .sql import register_toi_seconds  # noqa: F401
