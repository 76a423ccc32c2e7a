"""Run parameters."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import ROUND_HALF_EVEN, Decimal


@dataclass(frozen=True)
class Cutoff:
    """An e-value cutoff as mantissa and exponent."""

    mant: float
    exp: int

    @staticmethod
    def parse(text: str) -> Cutoff:
        """``1e-5`` and the like; a negative number is an exponent with mantissa 1; zero is no cutoff."""
        value = Decimal(str(text))
        if value < 0:
            return Cutoff(1.0, int(value))
        if value == 0:
            raise ValueError("an e-value cutoff must not be zero")
        exp = value.adjusted()
        mant = value.scaleb(-exp).quantize(Decimal("0.01"), ROUND_HALF_EVEN)
        return Cutoff(float(mant), exp)


@dataclass(frozen=True)
class PairConfig:
    """Cutoffs of the pair stages. ``legacy``: compare exponents only, zero e-values included."""

    percent_match: float = 50.0
    evalue: Cutoff = Cutoff(1.0, -5)
    legacy: bool = False


@dataclass(frozen=True)
class FlowConfig:
    """Parameters of flow clustering: inflation, what a column keeps after expansion, and the start.

    ``initial_rounds`` are run with ``initial_inflation`` before the others; loops, the largest weight
    of their node, are multiplied by ``loop_scale``; ``pre_inflation`` is applied to the start. After
    ``most_rounds`` the state is taken as it is, with a warning where the distributed loop ran."""

    inflation: float = 1.5
    prune: int = 10_000
    select: int = 1_100
    recover: int = 1_400
    mass: float = 0.9
    chaos: float = 1e-4
    most_rounds: int = 10_000
    initial_rounds: int = 0
    initial_inflation: float = 2.0
    loop_scale: float = 1.0
    pre_inflation: float = 1.0

    def power(self, done: int) -> float:
        """Inflation of the round after ``done`` rounds."""
        return self.initial_inflation if done < self.initial_rounds else self.inflation


@dataclass(frozen=True)
class RunConfig:
    pairs: PairConfig = PairConfig()
    flow: FlowConfig = FlowConfig()
    prefix: str = "OG"
    start: int = 1000
