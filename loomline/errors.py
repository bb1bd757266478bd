"""Errors by what went wrong."""

from __future__ import annotations


class LoomlineError(Exception):
    """Any of these."""


class ConfigError(LoomlineError, ValueError):
    """A configuration with problems, all of which it lists."""

    def __init__(self, problems: list[str]):
        super().__init__("invalid config:\n- " + "\n- ".join(problems))
        self.problems = problems


class RunFailed(LoomlineError):
    """A stage failed; the report says which."""


class TooFewSamples(LoomlineError):
    """Generation stayed below its floor; ``found`` says what was made and what failed."""

    def __init__(self, message: str, found: dict):
        super().__init__(message)
        self.found = found


class ModelError(LoomlineError):
    """A text model failed for good."""


class TransientModelError(ModelError):
    """A failure that may not come again: time-outs, lost connections, rate limits."""


class BudgetExceeded(ModelError):
    """The spending cap was reached."""
