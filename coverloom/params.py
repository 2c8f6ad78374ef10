"""All knobs of the planner in one place."""

from __future__ import annotations

from dataclasses import dataclass, replace


def as_fraction(x: float) -> float:
    """Percentages may be given as 96 or as 0.96."""
    return x / 100 if x > 1 else x


@dataclass(frozen=True)
class Params:
    taxa_of_interest: str | None = None
    sequence_identity: float = 0.96
    window_size: int = 60
    min_sequence_coverage: float = 10
    num_samples: int = 2
    max_samples: int | None = None
    max_size_gbp: float | None = 50
    max_recovery_samples: int = 20
    max_sample_combinations: int = 100
    exclude: tuple[str, ...] = ()
    coassembly_samples: tuple[str, ...] = ()
    anchor_samples: tuple[str, ...] = ()
    abundance_weighted: bool = False
    abundance_weighted_samples: tuple[str, ...] = ()
    kmer_precluster: str = "large"
    precluster_size: int | None = None
    most_similar_first: bool = False
    min_appraised: float = 0.1
    trim_fraction: float = 0.1
    min_completeness: float = 70
    max_contamination: float = 10
    min_cluster_targets: int | None = None
    jaccard_threshold: float = 0.1
    kmer_length: int = 60

    def __post_init__(self):
        if self.max_samples is not None and self.max_samples < self.num_samples:
            raise ValueError("max_samples is less than num_samples")
        if self.kmer_precluster not in ("never", "large", "always"):
            raise ValueError("kmer_precluster is never, large or always")
        if self.anchor_samples and self.coassembly_samples and not set(self.anchor_samples) <= set(self.coassembly_samples):
            raise ValueError("anchor samples must be among the samples to assemble")

    @property
    def largest(self) -> int:
        return self.max_samples or self.num_samples

    @property
    def neighbours(self) -> int:
        return self.precluster_size or 5 * self.max_recovery_samples

    @property
    def max_size(self) -> float | None:
        return None if self.max_size_gbp is None else self.max_size_gbp * 1e9

    def single(self) -> Params:
        """One sample to an assembly, of any size."""
        return replace(self, num_samples=1, max_samples=1, max_size_gbp=None)

    def combinations_at(self, attempt: int) -> int:
        """The cap on pooled samples, lowered with each retry."""
        return max(1, self.max_sample_combinations + 25 - 25 * attempt)

    def preclusters(self, n_samples: int) -> bool:
        return self.kmer_precluster == "always" or self.kmer_precluster == "large" and n_samples > 1000
