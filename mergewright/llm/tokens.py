"""Byte-level BPE ids of whole texts by the tokenizers library, with repeated words encoded once.

A byte-level pre-tokeniser always starts a pre-token at a space or line feed
that stands alone between other characters, and ends one between a letter and a sign, so a text may be cut there and its
parts encoded apart. The parts of an Arrow batch are reduced to distinct ones
by Arrow; a distinct part is encoded once per Python worker and its ids are
gathered by numpy. Texts with runs of three blanks, or of two at their end, are
encoded whole, since such runs do not fall apart at each blank; so are texts that hold an added token
of the definition, which the library takes out before anything is cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from mergewright.llm import common

#: White space as the pre-tokeniser sees it, and more to be safe.
BLANK = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WHOLE = BLANK + "{3}|" + BLANK + r"{2}\z|\x00"
#: Letters, then at most one sign: two pre-tokens of which no merge can cross the boundary.
SIMPLE = r"^ ?\p{L}+[^\s\x00-\x20\x7f-\x{a0}\p{L}\p{N}\p{M}\p{Z}']?\z"
CUT = r"^( ?\p{L}+)([^\p{L}])\z"


#: Kinds of bytes that matter for cutting texts: others, signs, Latin letters, blanks, line feeds.
SIGN_BYTE, LETTER_BYTE, BLANK_BYTE, FEED_BYTE = 1, 2, 3, 4
KINDS_OF_BYTES = np.zeros(256, np.uint8)
KINDS_OF_BYTES[33:127] = SIGN_BYTE
KINDS_OF_BYTES[48:58] = 0
KINDS_OF_BYTES[65:91] = KINDS_OF_BYTES[97:123] = LETTER_BYTE
KINDS_OF_BYTES[32], KINDS_OF_BYTES[10] = BLANK_BYTE, FEED_BYTE
#: Distinct parts a worker keeps: some 50 MB.
KEEP = 200_000


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte: printable bytes stand for themselves, the rest follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def cut_parts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Parts of the texts that fall into whole pre-tokens, and the number of parts before each text (and after the last).

    A part begins at each blank, around each line feed, and at a sign after a Latin letter: a run of letters ends
    there in any case. The parts are views of the texts' own bytes.
    """
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(data, np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)
    kind = KINDS_OF_BYTES[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[:-1] = kind >= BLANK_BYTE
    feed = kind == FEED_BYTE
    cut[1:] |= feed
    cut[1:-1] |= (kind[1:] == SIGN_BYTE) & (kind[:-1] == LETTER_BYTE)
    cut[offsets - first] = True
    starts = np.flatnonzero(cut)
    split = pa.LargeStringArray.from_buffers(max(len(starts) - 1, 0), pa.py_buffer(starts), pa.py_buffer(data))
    return split, np.searchsorted(starts, offsets - first)


class Encoder:
    """Encodes texts; keeps up to ``keep`` distinct parts for later batches."""

    def __init__(self, definition: str, keep: int = KEEP):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(definition)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # One vocabulary in memory: the pre-tokeniser is exchanged for parts that are cut already.
        self.byte_level, self.lines = self.tokenizer.pre_tokenizer, pre_tokenizers.Split("\n", "removed")
        self.mark = self.tokenizer.token_to_id("Ċ")
        self.letters = byte_letters()
        self.table = {b: c for b, c in self.letters.items() if b not in (0, 10)}
        self.keep = keep
        self.index: dict[str, int] = {}
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int64)
        self.store = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def _encode_whole(self, texts: Sequence[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(
            list(texts), add_special_tokens=False)]

    def _encode_lines(self, lines: str) -> np.ndarray:
        """Ids of lines that are single pre-tokens in byte stand-ins."""
        self.tokenizer.pre_tokenizer = self.lines
        try:
            return np.array(self.tokenizer.encode_batch_fast([lines], add_special_tokens=False)[0].ids, np.uint32)
        finally:
            self.tokenizer.pre_tokenizer = self.byte_level

    def _learn(self, parts: pa.Array) -> None:
        """Add distinct parts to the store.

        Parts of letters with at most one sign go to the model many
        in one call: their pre-tokens are known, so they are handed over
        already cut, in byte stand-ins, and a stand-in of the line feed (a
        token of its own) ends each part.
        """
        simple = pc.match_substring_regex(parts, SIMPLE)
        ascii_only = pc.string_is_ascii(parts)
        for mask, letters in ((pc.and_(simple, ascii_only), False), (pc.and_not(simple, ascii_only), True)):
            some = parts.filter(mask)
            for at in range(0, len(some), 20_000):
                block = some.slice(at, 20_000)
                cut = pc.replace_substring_regex(block, CUT, "\\1\n\\2")
                joined = "\n\0\n".join(cut.to_numpy(zero_copy_only=False)) + "\n\0"
                if letters:
                    joined = joined.encode().decode("latin-1").translate(self.table)
                else:
                    joined = joined.replace(" ", self.letters[32])
                joined = joined.replace("\0", self.letters[10])
                ids = self._encode_lines(joined)
                ends = np.flatnonzero(ids == self.mark)
                starts = np.concatenate([[0], ends[:-1] + 1])
                self._add(block, ids, starts, ends - starts)
        other = parts.filter(pc.invert(simple))
        if len(other):
            encoded = self._encode_whole(other.to_pylist())
            sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
            self._add(other, np.concatenate(encoded), np.cumsum(sizes) - sizes, sizes)

    def _add(self, parts: pa.Array, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        n, m = len(self.index), len(parts)
        assert len(sizes) == m
        while len(self.starts) < n + m:
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        while len(self.store) < self.used + len(ids):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        self.starts[n:n + m] = self.used + starts
        self.lengths[n:n + m] = sizes
        self.store[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.index.update(zip(parts.to_numpy(zero_copy_only=False), range(n, n + m), strict=True))

    def _forget(self, n: int, used: int, parts: Sequence[str]) -> None:
        """Back to ``n`` parts: those of the last batch go."""
        for part in parts:
            self.index.pop(part, None)
        self.used = used
        assert len(self.index) == n

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; a null text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = pc.match_substring_regex(texts, WHOLE)
        for content in self.added:
            whole = pc.or_(whole, pc.match_substring(texts, content))
        whole = whole.to_numpy(zero_copy_only=False)
        out: list[np.ndarray | None] = [None] * len(texts)
        for i in np.flatnonzero(whole).tolist():
            out[i] = self._encode_whole([texts[i].as_py()])[0]
        rows = np.flatnonzero(~whole)
        if len(rows):
            some = texts if len(rows) == len(texts) else texts.take(pa.array(rows))
            split, bounds = cut_parts(some)
            coded = split.dictionary_encode()
            parts = coded.dictionary.to_numpy(zero_copy_only=False)
            known = np.fromiter(map(self.index.get, parts, repeat(-1)), np.int64, len(parts))
            n, used = len(self.index), self.used
            missing = np.flatnonzero(known < 0)
            new = parts[missing]
            if len(new):
                self._learn(coded.dictionary.take(pa.array(missing)))
                known[missing] = np.fromiter(map(self.index.__getitem__, new), np.int64, len(new))
            unit = known[coded.indices.to_numpy()]
            sizes = self.lengths[unit]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            at = np.repeat((self.starts[unit] - (ends - sizes)), sizes)
            at += np.arange(total)
            ids = self.store[at]
            edges = np.concatenate([[0], ends])[bounds]
            for row, a, b in zip(rows.tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                out[row] = ids[a:b]
            if n >= self.keep:
                self._forget(n, used, new)
        return out  # type: ignore[return-value]


def worker_encoder(text: str, keep: int = KEEP) -> Encoder:
    """The worker's encoder for a definition."""
    return common.worker_cache(f"encoder-{zlib.crc32(text.encode())}-{keep}", lambda: Encoder(text, keep))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def definition(path: str | None = None) -> str:
    """The tokenizer's file as text: read by the driver and sent to tasks, a bounded 1.5 MB."""
    with open(path or default_path(), encoding="utf-8") as file:
        return file.read()
