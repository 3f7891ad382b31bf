"""Errors of the pipeline and their codes."""

from __future__ import annotations

from pyspark.errors import PySparkException


class PipelineError(RuntimeError):
    """An error with a code of the engine's vocabulary."""

    def __init__(self, code: str, text: str = ""):
        super().__init__(f"{code} {text}".strip())
        self.code = code


# Codes of errors that carry none themselves, the more special class first.
CODES = (
    (FileNotFoundError, "INTERNAL_ERROR"),
    (PermissionError, "INTERNAL_ERROR"),
    (UnicodeDecodeError, "ENCODING_ERROR"),
    (TimeoutError, "PROCESSING_TIMEOUT"),
    (OSError, "INTERNAL_ERROR"),
    (PySparkException, "TEMPORARY_INTERNAL_ERROR"),
)


def error_code(error: BaseException) -> str:
    """Code of an exception: its own, that of its class, or PIPELINE_ERROR."""
    own = getattr(error, "code", None)
    if isinstance(own, str):
        return own
    return next((code for kind, code in CODES if isinstance(error, kind)), "PIPELINE_ERROR")
