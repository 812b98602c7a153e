"""Log records with the time since the stage began."""

from __future__ import annotations

import logging
import time


class Elapsed(logging.Formatter):
    """Puts the stage and its seconds before a message, without changing the record (so several handlers agree)."""

    def __init__(self, stage: str) -> None:
        super().__init__("%(asctime)s %(levelname)s %(message)s")
        self.stage, self.began = stage, time.monotonic()

    def formatMessage(self, record: logging.LogRecord) -> str:  # noqa: N802  the base class's name
        return f"[{self.stage} +{time.monotonic() - self.began:.1f}s] {super().formatMessage(record)}"


def stage_logger(stage: str, path: str | None = None, level: int = logging.INFO) -> logging.Logger:
    """The package's logger for one stage: to the console, and to a file if one is given."""
    logger = logging.getLogger("lodestrata")
    logger.setLevel(level)
    for old in list(logger.handlers):
        logger.removeHandler(old)
        old.close()
    for handler in [logging.StreamHandler(), *([logging.FileHandler(path)] if path else [])]:
        handler.setFormatter(Elapsed(stage))
        logger.addHandler(handler)
    return logger
