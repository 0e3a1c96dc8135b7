"""Settings of an annotation run."""

from __future__ import annotations

from dataclasses import dataclass, field

#: Databases in priority order; ties between scores go to the first.
DATABASES = ("KEGG", "FOAM", "Pfam", "dbCAN", "METABOLIC", "PHROG")
#: Databases that carry virus-likeness scores.
SCORED = ("KEGG", "Pfam", "PHROG")
#: Classes of auxiliary genes in priority order.
CLASSES = ("metabolic", "physiological", "regulatory")


@dataclass(frozen=True)
class CircularitySettings:
    """Bounds of terminal-repeat detection and of its quality flags."""

    min_repeat: int = 20
    max_inverted: int = 1000
    max_count: int = 8
    max_ambiguous: float = 0.2
    max_base_share: float = 0.70
    max_kmer_multiplicity: float = 1.5
    k: int = 15


@dataclass(frozen=True)
class EngineConfig:
    """All parameters of :class:`virelay.plans.annotate.Engine`.

    ``compat`` reproduces the original tool's quirks where results differ: the
    top hit of genes without hits is labelled with the first database, virus
    scores of other databases are lost for proteins without a Pfam score, and
    E-values are compared at two significant digits.
    """

    min_length: int = 5000
    min_genes: int = 4
    min_valid_pct: float = 0.20
    min_coverage: float = 0.5
    max_evalue: float = 1e-5
    min_bitscore: float = 50.0
    bitscore_fraction: float = 0.5
    soft_factor: float = 1.5
    window: int = 25000
    flank: int = 5000
    min_flank_vscore: float = 10.0
    use_hallmark: bool = False
    normalize_pfam: bool = False
    compat: bool = False
    circularity: CircularitySettings = field(default_factory=CircularitySettings)

    def __post_init__(self):
        if self.window < 1 or self.flank < 0:
            raise ValueError("window must be positive and flank not negative")
        for name in ("min_coverage", "bitscore_fraction"):
            if not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} must be between 0 and 1")

    @property
    def soft_bitscore(self) -> float:
        """Least score of a hit that rescues a soft keyword match."""
        return max(1.0, self.soft_factor) * self.min_bitscore

    @property
    def soft_coverage(self) -> float:
        return min(1.0, max(1.0, self.soft_factor) * self.min_coverage)
