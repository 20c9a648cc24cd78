"""Job parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

MODE_DATA = "data"
MODE_CLASSIFIER = "NCFOnly"
MODE_CLUSTERED = "NCFWithKmeans"


@dataclass(frozen=True)
class WordVectorParams:
    path: str = ""
    dim: int = 50


@dataclass(frozen=True)
class KMeansParams:
    k: int = 3
    max_iter: int = 20
    train: bool = True
    feature_col: str = "userVec"
    model_path: str = ""
    seed: int = 1


@dataclass(frozen=True)
class ClassifierParams:
    """Networks take ``epochs`` passes over batches of ``batch_size`` rows; step n has the size ``learning_rate / (1 + decay * n)``.

    For Spark's perceptron ``epochs`` bounds the iterations, ``batch_size`` is the block size, and the solver
    ``gd`` uses ``learning_rate``.
    """

    batch_size: int = 1024
    epochs: int = 20
    learning_rate: float = 5e-2
    decay: float = 1e-6
    train: bool = True
    model_path: str = ""
    hidden_layers: tuple[int, ...] = (40, 20, 10)
    seed: int = 1
    solver: str = "l-bfgs"


@dataclass(frozen=True)
class EmbeddingParams:
    """``multiply`` adds the product branch; ``block_ids`` and ``cell_rows`` bound what a task holds and trains on."""

    width: int = 20
    hidden_layers: tuple[int, ...] = (20, 10)
    multiply: bool = True
    epochs: int = 10
    batch_size: int = 256
    learning_rate: float = 5e-2
    decay: float = 1e-6
    spread: float = 0.1
    seed: int = 1
    block_ids: int = 200_000
    cell_rows: int = 1_000_000


@dataclass(frozen=True)
class AlsParams:
    max_iter: int = 5
    reg: float = 0.01
    rank: int = 10
    implicit: bool = True
    seed: int = 1


@dataclass(frozen=True)
class DataParams:
    raw: str = ""
    preprocessed: str = ""
    model_output: str = ""
    evaluate: str = ""
    label_col: str = "is_clicked"
    files: int | None = None  # unset: every task writes its own file


@dataclass(frozen=True)
class AppParams:
    data: DataParams = field(default_factory=DataParams)
    word_vectors: WordVectorParams = field(default_factory=WordVectorParams)
    kmeans: KMeansParams = field(default_factory=KMeansParams)
    classifier: ClassifierParams = field(default_factory=ClassifierParams)
    negative_k: int = 0  # drawn pairs for each interaction of a training job, beside the label 0 of the data
    mode: str = MODE_CLASSIFIER
