"""Run parameters, with the function defaults and a more permissive preset."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, fields, replace


@dataclass(frozen=True)
class LoadConfig:
    min_length: int = 30
    require_topics: bool = True
    language_filter: bool = True


@dataclass(frozen=True)
class EmbedConfig:
    batch_size: int = 100
    dim: int = 256


@dataclass(frozen=True)
class ClusterConfig:
    min_cluster_size: int = 3
    max_cluster_size: int = 5
    min_cluster_similarity: float = 0.6
    min_seo_similarity: float = 0.8
    min_unique_users: int = 3
    cluster_selection_epsilon: float = 0.1
    min_samples: int = 2
    # Distinct vectors of the largest topic that a task solves by itself, in tiles of distances.
    tile_rows: int = 6000
    # Vectors of one block of a topic beyond that; a task holds two blocks.
    block_bytes: int = 128 << 20
    # Edges, three numbers each, that one task works through one after the other.
    tree_rows: int = 500_000

    def __post_init__(self) -> None:
        if self.min_cluster_size < 2:
            raise ValueError("min_cluster_size must be at least 2")
        if self.max_cluster_size < 1:
            raise ValueError("max_cluster_size must be at least 1")
        if self.min_samples < 1:
            raise ValueError("min_samples must be at least 1")
        if self.tile_rows < 4:
            raise ValueError("tile_rows must be at least 4")
        if self.tree_rows < 1:
            raise ValueError("tree_rows must be at least 1")


@dataclass(frozen=True)
class SeoConfig:
    queries_per_cluster: int = 1


@dataclass(frozen=True)
class PipelineConfig:
    load: LoadConfig = field(default_factory=LoadConfig)
    embed: EmbedConfig = field(default_factory=EmbedConfig)
    cluster: ClusterConfig = field(default_factory=ClusterConfig)
    seo: SeoConfig = field(default_factory=SeoConfig)

    def with_params(self, **params: object) -> "PipelineConfig":
        """Set parameters by name, whichever section they belong to."""
        sections = {f.name: getattr(self, f.name) for f in fields(self)}
        for name, value in params.items():
            owner = next((s for s, cfg in sections.items() if name in asdict(cfg)), None)
            if owner is None:
                raise TypeError(f"unknown pipeline parameter: {name}")
            sections[owner] = replace(sections[owner], **{name: value})
        return PipelineConfig(**sections)


# The preset that accepts smaller and looser clusters.
PERMISSIVE = PipelineConfig(
    cluster=ClusterConfig(
        min_cluster_size=2,
        max_cluster_size=5,
        min_cluster_similarity=0.1,
        min_seo_similarity=0.3,
        min_unique_users=1,
    )
)


def get_pipeline_config() -> dict[str, dict[str, object]]:
    """The permissive preset as a nested dictionary, one entry per stage."""
    cluster = asdict(PERMISSIVE.cluster)
    return {
        "data_loading": asdict(PERMISSIVE.load),
        "embedding": asdict(PERMISSIVE.embed),
        "clustering": {
            name: cluster[name]
            for name in (
                "min_cluster_size",
                "max_cluster_size",
                "min_cluster_similarity",
                "min_seo_similarity",
                "min_unique_users",
            )
        },
        "seo_generation": asdict(PERMISSIVE.seo),
    }
