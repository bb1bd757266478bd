"""A text model behind retries, pacing and a budget."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from loomline.errors import BudgetExceeded, ModelError, TransientModelError


@dataclass
class ModelClient:
    """Calls ``complete(prompt)``: again after failures that may pass, with growing pauses, and within a budget.

    The budget is checked before and after each call; costs are estimated at four characters a token.
    """

    complete: Callable[[str], str]
    max_retries: int = 4
    backoff_s: float = 1.0
    backoff_cap_s: float = 60.0
    min_interval_s: float = 0.0
    budget_usd: float = 0.0
    price_per_1m_input: float = 0.0
    price_per_1m_output: float = 0.0
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    rng: random.Random = field(default_factory=random.Random)
    counts: dict[str, int] = field(
        default_factory=lambda: dict.fromkeys(
            ("calls", "retries", "transient_failures", "fatal_failures", "est_input_tokens", "est_output_tokens"), 0
        )
    )
    _last: float | None = None

    @property
    def cost(self) -> float:
        return (self.counts["est_input_tokens"] * self.price_per_1m_input + self.counts["est_output_tokens"] * self.price_per_1m_output) / 1e6

    def stats(self) -> dict:
        return {**self.counts, "est_cost_usd": round(self.cost, 6), "cost_is_estimate": True}

    def _within_budget(self) -> None:
        if 0 < self.budget_usd <= self.cost:
            raise BudgetExceeded(f"estimated cost {self.cost:.4f} reaches the budget {self.budget_usd:.4f}")

    def __call__(self, prompt: str) -> str:
        self._within_budget()
        for attempt in range(max(0, self.max_retries) + 1):
            if self._last is not None and (wait := self._last + self.min_interval_s - self.clock()) > 0:
                self.sleep(wait)
            self._last = self.clock()
            try:
                text = self.complete(prompt)
            except (TimeoutError, ConnectionError, TransientModelError):
                self.counts["transient_failures"] += 1
                if attempt >= self.max_retries:
                    self.counts["fatal_failures"] += 1
                    raise
                self.counts["retries"] += 1
                self.sleep(min(self.backoff_s * 2**attempt, self.backoff_cap_s) * (0.5 + self.rng.random()))
            except BudgetExceeded:
                self.counts["fatal_failures"] += 1
                raise
            except Exception as e:
                self.counts["fatal_failures"] += 1
                raise ModelError(f"text model failed: {e}") from e
            else:
                break
        self.counts["calls"] += 1
        self.counts["est_input_tokens"] += max(1, len(prompt) // 4)
        self.counts["est_output_tokens"] += max(1, len(text or "") // 4)
        self._within_budget()
        return text
