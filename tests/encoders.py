"""A tiny encoder folder: a tokenizer of words, and a model that looks hidden states up in a table."""

import json
from pathlib import Path

import numpy as np
from tokenizers import Tokenizer, models, pre_tokenizers, processors

WORDS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", *"abcdefghi", "Alpha", "beta"]


def varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(number: int, value: int | bytes | str) -> bytes:
    """A field of a protocol buffer."""
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    value = value.encode() if isinstance(value, str) else value
    return varint(number << 3 | 2) + varint(len(value)) + value


def tensor(name: str, kind: int, *dims: str | int) -> bytes:
    shape = b"".join(field(1, field(1 if isinstance(d, int) else 2, d)) for d in dims)
    return field(1, name) + field(2, field(1, field(1, kind) + field(2, shape)))


def tiny_encoder(folder: Path, limit: int = 8) -> str:
    folder.mkdir()
    tokenizer = Tokenizer(models.WordLevel({w: i for i, w in enumerate(WORDS)}, unk_token="[UNK]"))
    tokenizer.pre_tokenizer = pre_tokenizers.Whitespace()
    tokenizer.post_processor = processors.TemplateProcessing(single="[CLS] $A [SEP]", special_tokens=[("[CLS]", 2), ("[SEP]", 3)])
    tokenizer.save(str(folder / "tokenizer.json"))
    (folder / "tokenizer_config.json").write_text(json.dumps({"model_max_length": 10**30}))
    (folder / "config.json").write_text(json.dumps({"max_position_embeddings": limit}))
    ids = np.arange(len(WORDS), dtype=np.float32)
    table = np.stack([ids, 2 * ids, np.ones_like(ids)], axis=1)
    node = field(1, "table") + field(1, "input_ids") + field(2, "last_hidden_state") + field(4, "Gather")
    held = b"".join(field(1, d) for d in table.shape) + field(2, 1) + field(8, "table") + field(9, table.tobytes())
    graph = field(1, node) + field(2, "g") + field(5, held) + field(11, tensor("input_ids", 7, "b", "t")) + field(12, tensor("last_hidden_state", 1, "b", "t", 3))
    (folder / "model.onnx").write_bytes(field(1, 8) + field(7, graph) + field(8, field(1, "") + field(2, 13)))
    return str(folder)
