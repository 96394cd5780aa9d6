"""Names, splits and targets of a scored essay collection."""

from __future__ import annotations

# The target columns, splits and score range of the collection.
TARGETS = ("formal_register", "thematic_coherence", "narrative_rhetorical_structure", "cohesion")
SPLITS = ("train", "valid", "test")
SCORES = (1, 2, 3, 4, 5)
REQUIRED_FILES = ("train.csv", "valid.csv", "test.csv", "sample_submission.csv")
EXPECTED_ROWS = {"train": 740, "valid": 125, "test": 370}

TEXT_COLUMNS = ("id", "essay", "prompt")


def columns_of(split: str) -> tuple[str, ...]:
    return TEXT_COLUMNS if split == "test" else (*TEXT_COLUMNS, *TARGETS)
