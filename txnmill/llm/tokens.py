"""Public tokenizers inside tasks: loaded once per worker process, with the bytes of every token as flat tables."""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
from dataclasses import dataclass

import numpy as np


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file of the installed ``public_tokenizers``."""
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass
class Pieces:
    """Strings of bytes by number: ``flat[start[i] : start[i] + size[i]]``."""

    flat: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, parts: list[bytes]) -> Pieces:
        size = np.array([len(p) for p in parts], np.int64)
        return cls(np.frombuffer(b"".join(parts), np.uint8), np.cumsum(size) - size, size)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ``ids``, one after another."""
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.start[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones stand for themselves, the
    others, in order, for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


@functools.lru_cache(maxsize=4)
def byte_level(path: str, plain: bool):
    """(tokenizer, pieces) of a byte-level BPE file. ``plain``: strings of special tokens in a text are ordinary text."""
    # One task has one core.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain
    tokenizer.no_truncation()
    tokenizer.no_padding()
    alphabet = byte_alphabet()
    names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return tokenizer, Pieces.of([bytes(alphabet[c] for c in n) if all(c in alphabet for c in n) else n.encode() for n in names])


@functools.lru_cache(maxsize=4)
def piece_model(path: str):
    """(processor, pieces) of a sentencepiece file with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    parts = []
    for i in range(model.get_piece_size()):
        name = model.id_to_piece(i)
        parts.append(bytes([int(name[3:-1], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode())
    return model, Pieces.of(parts)


def cut_at_spaces(tokenizer, model) -> bool:
    """Whether both tokenizers work on ``x y`` as on ``x`` and `` y`` where ``x`` ends and ``y`` starts with a printable
    ASCII character: the byte-level pattern has a blank only in front of a match or in a run of blanks, and no piece has
    a blank behind another character, so no merge reaches over the cut."""
    made = json.loads(tokenizer.to_str())
    before, added = made["pre_tokenizer"] or {}, made["added_tokens"]
    pattern = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    alone = made["normalizer"] is None and (made["model"].get("dropout") or 0) == 0 and all(t["special"] for t in added)
    within = re.compile("[^\u2581]\u2581")
    return bool(pattern and alone) and not any(within.search(model.id_to_piece(i)) for i in range(model.get_piece_size()))


def flat_ids(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, place of the first id of each list and the end)."""
    counts = np.array([len(x) for x in lists], np.int64)
    ends = np.append(0, np.cumsum(counts))
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(ends[-1])), ends
