"""The representations by name."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Representation:
    name: str
    family: str
    storage: str
    format: str = "parquet"


# The names and families of the representations.
CATALOG = {
    r.name: r
    for r in (
        Representation("bow", "frequency", "sparse"),
        Representation("tf", "frequency", "sparse"),
        Representation("tfidf", "frequency", "sparse"),
        Representation("word2vec_cbow", "static_semantic", "dense"),
        Representation("word2vec_skipgram", "static_semantic", "dense"),
        Representation("structural", "structural", "dense"),
        Representation("essay_prompt", "relationship", "dense"),
        Representation("bert", "contextual", "dense"),
    )
}
DEFAULT_SET = ("bow", "tf", "tfidf", "structural")


def canonical(name: str, architecture: str = "cbow") -> str:
    full = f"word2vec_{architecture.lower()}" if name == "word2vec" else name
    if full not in CATALOG:
        raise ValueError(f"{full} is no representation; there are {', '.join(CATALOG)}")
    return full
