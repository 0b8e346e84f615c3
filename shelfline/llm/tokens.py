"""What the two tokenizers share: codecs kept by a Python worker, bounded memories, and documents in and out."""

import hashlib
from collections import OrderedDict
from collections.abc import Callable, Hashable, Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words that a codec remembers in each of two generations, and parts of words.
WORDS_REMEMBERED = 200_000
PARTS_REMEMBERED = 100_000
#: Codecs that a worker keeps; with more, the one that was used last long ago goes.
CODECS = 2
#: Characters of texts that a task encodes together.
CHARS_AT_ONCE = 1 << 22
_codecs: OrderedDict[Hashable, object] = OrderedDict()


class Remembered(dict):
    """``make(key)`` of the keys asked for, kept in two generations: when the younger one is full, it replaces the
    older one, so that what is asked for often is never lost, and no more than twice ``most`` is kept."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most = make, most
        self.older: dict = {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        self[key] = found
        return found


def kept_by_worker(key: Hashable, make: Callable):
    """``make()``, made once by a Python worker for all of its tasks, with what it remembers."""
    if key not in _codecs:
        while len(_codecs) >= CODECS:
            _codecs.popitem(last=False)
        _codecs[key] = make()
    _codecs.move_to_end(key)
    return _codecs[key]


def digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def words_to_ids(codec, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, one after another, and where each text's ids end, from 0 on.

    The codec gives the words of a text, and remembers their ids, as packed numbers of four bytes; a word that the texts have many times is
    looked up once.
    """
    words = [codec.words(t) if t else [] for t in texts]
    ends = np.cumsum([0, *map(len, words)])
    coded = pa.array(chain.from_iterable(words), pa.large_string()).dictionary_encode()
    entries = list(map(codec.of_word.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False)))
    sizes = np.fromiter(map(len, entries), np.int64, len(entries)) >> 2
    starts = np.cumsum(sizes) - sizes
    pool = np.frombuffer(b"".join(entries), np.int32)
    places = coded.indices.to_numpy()
    taken = sizes[places]
    after = np.concatenate(([0], np.cumsum(taken)))
    ids = pool[np.repeat(starts[places] - after[:-1], taken) + np.arange(after[-1])]
    ends = after[ends]
    if codec.end is not None:
        ids = np.insert(ids, ends[1:], codec.end)
        ends = ends + np.arange(len(ends))
    return ids, ends


def _some(texts: Iterable[str | None]) -> Iterator[list[str | None]]:
    """The texts, so many at a time that they have ``CHARS_AT_ONCE`` characters, or one longer text."""
    held: list[str | None] = []
    size = 0
    for text in texts:
        held.append(text)
        size += 1 + len(text or "")
        if size >= CHARS_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def encoded(docs: DataFrame, codec_of: Callable, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (only the columns ``keep``, if given) with n_tokens and token_ids; columns of those names are replaced.

    Every whole text is encoded. Repeated rows come out each; an empty table gives no rows. Nothing is shuffled.
    Tasks hand on the ids of some hundred documents at a time.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("n_tokens", "token_ids")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of()
        for batch in batches:
            at = 0
            for texts in _some(x.as_py() for x in batch.column(batch.num_columns - 1)):
                ids, ends = words_to_ids(codec, texts)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                part = batch.slice(at, len(texts))
                at += len(texts)
                counts = pa.array(np.diff(ends), pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], counts, lists], names=names)

    # Names of its own inside, because not all functions take names with dots.
    names = [f"c{i}" for i in range(len(kept) + 2)]
    kinds = [*(docs.schema[c].dataType for c in kept), T.LongType(), T.ArrayType(T.IntegerType())]
    rows = docs.select(*(F.col(f"`{c}`").alias(name) for c, name in zip(kept, names)), F.col(f"`{text}`").alias("text"))
    found = rows.mapInArrow(run, T.StructType([T.StructField(name, kind) for name, kind in zip(names, kinds)]))
    return found.toDF(*kept, "n_tokens", "token_ids")


def with_digests(docs: DataFrame, codec_of: Callable, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 (of the decimal ids, joined by a space) and decoded_sha256 (of the text that
    the ids decode to), in lowercase hexadecimal; columns of those names are replaced.

    Encodes and decodes every whole text within one task, for ids and decoded texts are far larger than the result.
    """
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]

    def joined(table: pa.Array, ids: np.ndarray, ends: np.ndarray, joint: bytes) -> pa.Array:
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), table.take(pa.array(ids))), joint)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = codec_of()
        decimal = pa.array([str(i).encode() for i in range(len(codec.data))], pa.binary())
        strings = pa.array(codec.data, pa.binary())
        for batch in batches:
            found = []
            for texts in _some(batch):
                ids, ends = words_to_ids(codec, texts)
                numbers = joined(decimal, ids, ends, b" ")
                decoded = joined(strings, ids, ends, codec.joint)
                for start, end, of_ids, of_text in zip(ends, ends[1:], numbers, decoded):
                    text = codec.finished(ids[start] if start < end else None, of_text.as_py())
                    found.append((int(end - start), hashlib.sha256(of_ids.as_buffer()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
            yield pd.DataFrame(found, columns=names)

    rows = docs.withColumn("_found", F.pandas_udf(run, "n_tokens long, ids_sha256 string, decoded_sha256 string")(F.col(f"`{text}`")))
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns if c not in names), "_found.*")


class OnSpark:
    """A codec in tasks: ``make(shared.value)``, made once by a worker for each ``key``."""

    def __init__(self, key: Hashable, shared: Broadcast, make: Callable):
        self.key, self.shared, self.make = key, shared, make

    def codec(self):
        """In a task."""
        return kept_by_worker(self.key, lambda: self.make(self.shared.value))

    def encode(self, text: Column) -> Column:
        """array<int> of the ids of the whole text; a null text is an empty one."""

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            codec = self.codec()
            for texts in batches:
                yield pd.Series([np.array(codec.encode(t), dtype=np.int32) for t in texts], dtype=object)

        return F.pandas_udf(run, "array<int>")(text)

    def decode(self, ids: Column) -> Column:
        """The decoded text; empty for a null or empty array."""

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            codec = self.codec()
            for rows in batches:
                yield pd.Series([codec.decode(() if x is None else x) for x in rows], dtype=object)

        return F.pandas_udf(run, "string")(ids)
