from .score import score_stream, write_stream  # noqa: F401
from .sync import compact, fold, latest_rows, sync_latest, vacuum  # noqa: F401
