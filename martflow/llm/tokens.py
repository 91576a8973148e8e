"""Token ids of texts, by a public tokenizer file."""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from martflow.llm.blocks import blocks

END = 2
#: Distinct pieces whose ids a process keeps; beyond that it forgets the least used half.
CACHE_PIECES = 400_000

# fixed values: the only normalizer and pre-tokenizer whose pieces are cut here
_NORMALIZER = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# the same classes for characters up to U+00FF, which those normalizers only bring to lower case
_LETTER, _NUMBER, _SPACE = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
_PIECES = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+"
)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Places(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = place = len(self)
        return place


class Encoder:
    """Ids of texts in blocks, with a memory of pieces.

    Where the tokenizer is of the kind described above, a text of characters up to
    U+00FF is cut into its pieces here and the tokenizer's model gives each distinct
    piece its ids once. All other texts and tokenizers go to the library whole; the
    ids are the same.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as file:
            told = json.load(file)
        steps = (told.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.cuts = (
            (told.get("normalizer") or {}).get("normalizers") == _NORMALIZER
            and len(steps) == 2
            and steps[0].get("pattern") == {"Regex": _SPLIT}
            and (steps[0]["behavior"], steps[0]["invert"]) == ("Removed", True)
            and (steps[1]["type"], steps[1]["use_regex"]) == ("ByteLevel", False)
            and not steps[1]["add_prefix_space"]
            and told.get("truncation") is None
        )
        self.special = [x["content"] for x in told.get("added_tokens", [])]
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._reset()

    def _reset(self) -> None:
        self.place = _Places()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)
        self.used = 0

    def _forget(self) -> None:
        """Keep the more used half of the pieces, and of their ids."""
        kept = np.sort(np.argpartition(-self.uses, CACHE_PIECES // 2)[: CACHE_PIECES // 2])
        names = list(self.place)
        self.place = _Places((names[i], n) for n, i in enumerate(kept.tolist()))
        first, size = self.first[kept], self.size[kept]
        ends = np.cumsum(size)
        self.used = int(ends[-1])
        self.ids = self.ids[np.repeat(first - ends + size, size) + np.arange(self.used)]
        self.first, self.size, self.uses = ends - size, size, self.uses[kept]

    def _learn(self) -> None:
        new = list(self.place)[len(self.size) :]
        coded = self.model.encode_batch_fast(new, add_special_tokens=False)
        found = [x.ids for x in coded]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ends = self.used + np.cumsum(sizes)
        need = int(ends[-1])
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(need, len(self.ids)), np.uint32)])
        self.ids[self.used : need] = [i for x in found for i in x]
        self.first = np.concatenate([self.first, ends - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.used = need

    def _plain(self, text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return self.cuts and not any(s in text for s in self.special)

    def block(self, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block, and where each text's ids begin."""
        if len(self.place) > CACHE_PIECES:
            self._forget()
        texts = [raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        whole = self._plain(raw.decode())
        plain = [whole or self._plain(t) for t in texts]
        find, place = _PIECES.findall, self.place
        cut = [[place[p] for p in find(t.lower())] if ok else [] for t, ok in zip(texts, plain, strict=True)]
        if len(place) > len(self.size):
            self._learn()
        counts = np.cumsum([0, *map(len, cut)])
        flat = np.fromiter(chain.from_iterable(cut), np.int64, int(counts[-1]))
        self.uses = np.bincount(flat, minlength=len(self.size)) + np.append(
            self.uses, np.zeros(len(self.size) - len(self.uses), np.int64)
        )
        sizes = self.size[flat]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.first[flat] - ends[:-1], sizes) + np.arange(int(ends[-1]))]
        at = ends[counts]
        if all(plain):
            return ids, at
        rest = [t for t, ok in zip(texts, plain, strict=True) if not ok]
        coded = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        parts = [
            ids[at[i] : at[i + 1]] if ok else np.array(next(coded).ids, np.uint32)
            for i, ok in enumerate(plain)
        ]
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of this process: tasks that follow each other share what it has learned."""
    return Encoder(path)


def encoded(
    texts: pa.Array, coder: Encoder, end: int = END
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per block: first row, ids with the end id after each text, offsets of the texts in them."""
    for first, offsets, data in blocks(texts):
        ids, at = coder.block(data.tobytes(), offsets)
        count = len(at) - 1
        ends = at + np.arange(count + 1)
        out = np.full(len(ids) + count, end, np.uint32)
        keep = np.ones(len(out), bool)
        keep[ends[1:] - 1] = False
        out[keep] = ids
        yield first, out, ends
