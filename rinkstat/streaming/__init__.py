from .incremental import game_log_batch, start_game_log_ingest  # noqa: F401
