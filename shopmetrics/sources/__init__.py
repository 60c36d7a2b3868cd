from shopmetrics.sources.binding import Star, star  # noqa: F401
