"""Packing token sequences into windows by minimum bin slack.

A document longer than a window is cut into full windows and a rest.  The rests are packed window by window: the longest
one left opens it, and a subset-sum dynamic programme over the remaining lengths (a bitset: bit ``s`` says that
``s`` tokens can be reached) finds the multiset of lengths that comes closest to the free space; walking the
stored bitsets back gives how many of each length to take.  Windows that cannot be filled wait for
more documents.  What is left at the end of a partition is cut at powers of two, lengths that
need no padding, so that no sequence is padded at all.

Each partition packs for itself, in blocks of at most ``block_tokens`` buffered tokens: no shuffle, bounded memory, and a lost
task repeats with the same result.  Sequence ids hold the partition in the upper bits.

Defined results: a NULL text is packed like the empty one, as its end token; rows that repeat an id are packed each for
itself; ties in length are taken in the order of rows; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections import defaultdict, deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daymart.llm.tables import extended

#: Bounds of a worker's caches, in entries of about 200 bytes, two generations each.  A pre-token costs far more to make than a word.
WORDS_KEPT, PARTS_KEPT = 300_000, 800_000


def best_fill(lengths: list[tuple[int, int]], space: int) -> list[tuple[int, int]]:
    """(length, count) taken from (length, available) so that the sum comes closest to ``space`` without passing it."""
    full = (1 << (space + 1)) - 1
    reach, stages = 1, []
    for length, available in lengths:
        if length > space:
            continue
        stages.append((length, available, reach))
        step, left = 1, min(available, space // length)
        while left > 0:  # counts by binary splitting
            take = min(step, left)
            reach |= (reach << (length * take)) & full
            left -= take
            step *= 2
        if reach >> space & 1:
            break
    total = reach.bit_length() - 1
    taken = []
    for length, available, before in reversed(stages):
        count = 0
        while not before >> total & 1:
            total -= length
            count += 1
        if count:
            taken.append((length, count))
    return taken


class Packer:
    """Takes pieces (key, start, ids) and hands out sequences: lists of them with a total of a window or a power of two."""

    def __init__(self, window: int) -> None:
        self.window = window
        self.waiting: dict[int, deque] = defaultdict(deque)
        self.tokens = 0

    def add(self, key: int, ids: np.ndarray) -> Iterator[list]:
        cut = len(ids) // self.window * self.window
        for start in range(0, cut, self.window):
            yield [(key, start, ids[start : start + self.window])]
        if cut < len(ids):
            self.waiting[len(ids) - cut].append((key, cut, ids[cut:]))
            self.tokens += len(ids) - cut

    def _take(self, length: int, count: int = 1) -> list:
        own = self.waiting[length]
        out = [own.popleft() for _ in range(count)]
        if not own:
            del self.waiting[length]
        self.tokens -= length * count
        return out

    def fill(self, least: int) -> Iterator[list]:
        """Full windows while more than ``least`` tokens wait.

        Once the longest rest cannot be completed to a full window it stays for later.
        """
        held: list = []
        while self.tokens > least and self.waiting:
            longest = max(self.waiting)
            opening = self._take(longest)
            free = self.window - longest
            taken = best_fill([(n, len(self.waiting[n])) for n in sorted(self.waiting, reverse=True)], free) if free else []
            if sum(n * c for n, c in taken) == free:
                yield opening + [piece for n, c in taken for piece in self._take(n, c)]
            else:
                held += opening
        for piece in held:
            self.waiting[len(piece[2])].append(piece)
            self.tokens += len(piece[2])

    def finish(self) -> Iterator[list]:
        """Full windows as far as they go, then what is left, cut at powers of two."""
        yield from self.fill(0)
        rest = [piece for n in sorted(self.waiting, reverse=True) for piece in self.waiting[n]]
        self.waiting.clear()
        left, self.tokens = self.tokens, 0
        at = 0
        while left:
            size = min(self.window, 1 << (left.bit_length() - 1))
            left -= size
            sequence = []
            while size:
                key, start, ids = rest[at]
                part = ids[:size]
                sequence.append((key, start, part))
                size -= len(part)
                if len(part) < len(ids):
                    rest[at] = (key, start + len(part), ids[len(part) :])
                else:
                    at += 1
            yield sequence


def _byte_signs() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte: printable ones themselves, the others from 256 on in turn."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {byte: chr(byte if byte in printable else next(others)) for byte in range(256)}


BYTE_SIGNS = _byte_signs()


class Known(dict):
    """A cache in two generations of ``kept`` entries, so that frequent ones stay; ``make`` finds what is missing."""

    def __init__(self, make: Callable[[str], bytes], kept: int) -> None:
        self.make, self.kept = make, kept
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.kept:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class WordTokenizer:
    """Ids of whole texts by a tokenizer that drops white space, with bounded caches; ids are kept as 32-bit bytes.

    Its pre-tokens never span white space, so a text's ids are those of its words in turn; words are cut into
    pre-tokens by the file's own pattern, and only pre-tokens not seen before are handed to the library: to the file's
    model directly, with the bytes of other than printable ASCII written as the model's alphabet has them.
    """

    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    #: The same for lower-case ASCII, for the faster standard matcher.
    PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+"
    #: Characters that are left to the tokenizer's own normalizer.
    BEYOND = re.compile("[\u0530-\U0010ffff]").search
    #: White space to Python, but not to the tokenizer.
    APART = re.compile("[\x1c-\x1f]").search

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.words, self.parts = Known(self._word, WORDS_KEPT), Known(self._part, PARTS_KEPT)
        self.split, self.split_plain = regex.compile(self.PIECES).findall, re.compile(self.PLAIN).findall
        self.tokenize, self.normalize = self.tokenizer.model.tokenize, self.tokenizer.normalizer.normalize_str

    def _part(self, part: str) -> bytes:
        if not (part.isascii() and part.isprintable()):
            part = part.encode().decode("latin-1").translate(BYTE_SIGNS)
        return array("I", [token.id for token in self.tokenize(part)]).tobytes()

    def _word(self, word: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, self.split_plain(word) if word.isascii() else self.split(word)))

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.APART(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.words.__getitem__, self.plain(text).split()))

    def plain(self, text: str) -> str:
        """Letter case and composed forms, settled for the whole text so that fewer words differ.

        Up to Cyrillic the standard library does what the file's normalizer does, but for the final sigma, which the latter has not.
        """
        if text.isascii():
            return text.lower()
        if not self.BEYOND(text):
            return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return self.normalize(text)


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One per worker process, so that its cache outlives a task."""
    if path not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def packed(
    docs: DataFrame,
    path: str,
    id: str = "doc_id",
    text: str = "text",
    window: int = 4096,
    end: int = 2,
    block_tokens: int = 8_000_000,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, its digest, and its ids if ``with_ids``."""
    frame = docs.select(F.col(id), F.col(f"`{text}`").alias("_text"))
    added = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids
    schema = extended(frame.select(id).schema, added)
    kind = pa.int64()

    def rows_of(sequences: Iterator[list], keys: list, numbers: Iterator[int]) -> Iterator[tuple]:
        for sequence in sequences:
            number, offset = next(numbers), 0
            for key, start, ids in sequence:
                raw = ids.tobytes()
                own = (keys[key][0], start, len(ids), zlib.crc32(raw), keys[key][1], number, offset)
                yield own + (raw,) if with_ids else own
                offset += len(ids)

    def batch_of(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows))
        kinds = [id_type] + [kind] * 6 + [pa.binary()] * with_ids
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenize = word_tokenizer(path)
        ending = np.array([end], "<u4").tobytes()
        base = TaskContext.get().partitionId() << 33
        numbers = iter(range(base, base + (1 << 33)))
        packer = Packer(window)
        keys: dict[int, tuple] = {}
        count, out, id_type = 0, [], None
        for batch in batches:
            id_type = batch.column(id).type
            for key, value in zip(batch.column(id).to_pylist(), batch.column("_text")):
                ids = np.frombuffer(tokenize(value.as_py()) + ending, "<u4")
                keys[count] = (key, len(ids))
                out += rows_of(packer.add(count, ids), keys, numbers)
                count += 1
                if packer.tokens >= block_tokens:
                    out += rows_of(packer.fill(block_tokens // 8), keys, numbers)
                    if packer.tokens >= block_tokens // 2:  # lengths that do not complete each other
                        out += rows_of(packer.finish(), keys, numbers)
                    waiting = {piece[0] for own in packer.waiting.values() for piece in own}
                    keys = {k: v for k, v in keys.items() if k in waiting}
                if len(out) >= 2_000:
                    yield batch_of(out, id_type)
                    out = []
        out += rows_of(packer.finish(), keys, numbers)
        if out:
            yield batch_of(out, id_type)

    return frame.mapInArrow(run, schema)
