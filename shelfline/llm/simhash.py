"""Near duplicates by SimHash: exact comparison of fingerprints in tiles."""

from collections.abc import Iterator
from itertools import accumulate, product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import frozen

SHINGLE_WORDS = 3
RADIUS = 3
HASH_SEED = 42
#: A tile's fingerprints agree in the number of ones of each of so many equal parts of the 64 bits.
PARTS = 4
TILE_ROWS = 1024
#: Fingerprint pairs that are compared at once.
_BLOCK = 1 << 18
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of the text's word shingles as unsigned 64 bits: a one where over half the shingle hashes have one.

    A-Z are lower-cased, words are what ASCII white space separates, repeated shingles count each time. Fewer
    words than a shingle are one shingle; a null or empty text has fingerprint 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    n = max(1, len(words) - shingle_words + 1)
    digest, width = xxhash.xxh64_intdigest, min(shingle_words, len(words))
    hashes = np.array([digest(joined[starts[i] : starts[i + width] - 1], HASH_SEED) for i in range(n)], dtype="<u8")
    # How often each of the eight bytes has each value, and from that how often each bit is one.
    values = hashes.view(np.uint8).reshape(n, 8) + np.arange(0, 2048, 256)
    ones = np.bincount(values.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits((2 * ones > n).astype(np.uint8), axis=1, bitorder="little").tobytes(), "little")


def fingerprints(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as bigint with the same 64 bits."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle_words) for t in texts], dtype=np.uint64).view(np.int64))

    return run(text)


def as_hex(bits: Column) -> Column:
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


def spanning_links(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of all pairs (of ``a`` with ``b``, or within ``a``) within the radius.

    Every pair is compared, but of a dense group only as many links are returned as it has members: a pair is
    dropped if the links so far connect it already.
    """
    nodes = a if b is None else np.concatenate([a, b])
    label = np.arange(len(nodes))
    left, right = [], []
    others, shift = (a, 0) if b is None else (b, len(a))
    step = max(1, _BLOCK // max(1, len(others)))
    for start in range(0, len(a), step):
        rows = a[start : start + step]
        near = np.bitwise_count(rows[:, None] ^ others[None, :]) <= radius
        if b is None:
            near &= np.arange(len(a))[None, :] > np.arange(start, start + len(rows))[:, None]
        for i in np.flatnonzero(near.any(axis=1)):
            me = start + i
            hits = np.flatnonzero(near[i]) + shift
            groups, first = np.unique(label[hits], return_index=True)
            new = groups != label[me]
            if new.any():
                left.append(np.full(new.sum(), nodes[me]))
                right.append(nodes[hits[first[new]]])
                label[np.isin(label, groups[new])] = label[me]
    if not left:
        return nodes[:0], nodes[:0]
    return np.concatenate(left), np.concatenate(right)


def _offsets(radius: int, parts: int) -> list[tuple[int, ...]]:
    """Differences of the counts of ones that two fingerprints within the radius can have, one of each ± pair."""
    zero = (0,) * parts
    near = product(range(-radius, radius + 1), repeat=parts)
    return [d for d in near if sum(map(abs, d)) <= radius and d >= zero]


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS, parts: int = PARTS) -> DataFrame:
    """(a, b): links that connect exactly those of the distinct fingerprints ``prints.bits`` that pairs within
    ``radius`` differing bits connect.

    Fingerprints are tiled by the counts of ones in ``parts`` parts of their bits; a difference of d bits
    changes the counts by at most d in sum, so all tile pairs further apart are skipped. A tile has about
    ``tile_rows`` fingerprints however many there are: larger cells are dealt over several tiles by hash.
    Every tile is sent, packed, to the tiles it has to be compared with, which hold one sent tile at a time.
    """
    width = 64 // parts
    mask = (1 << width) - 1
    ones = [F.bit_count(F.shiftrightunsigned("bits", width * i).bitwiseAND(F.lit(mask))) for i in range(parts)]
    cells = prints.select("bits", *(c.alias(f"c{i}") for i, c in enumerate(ones)))
    names = [f"c{i}" for i in range(parts)]
    # At most (width + 1) ** parts rows, 83521 for four parts, however many fingerprints there are.
    sizes = frozen(cells.groupBy(*names).agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("n"))).hint("broadcast")
    tiles = (
        cells.join(sizes, names)
        .groupBy(*names, F.pmod(F.xxhash64("bits"), "n").cast("int").alias("tile"))
        .agg(F.collect_list("bits").alias("packed"))
    )
    steps = F.array(*(F.struct(*(F.lit(x).alias(f"d{i}") for i, x in enumerate(d))) for d in _offsets(radius, parts)))
    sent = tiles.select(*names, "tile", "packed", F.explode(steps).alias("d"))
    at_home = " and ".join(f"d.d{i} = 0" for i in range(parts))
    sent = sent.select(
        *((F.col(c) + F.col(f"d.d{i}")).alias(c) for i, c in enumerate(names)), "packed", F.when(F.expr(at_home), F.col("tile")).alias("home")
    ).join(sizes, names)
    # In its own cell a tile goes to itself and to the tiles after it.
    sent = sent.select(
        *names, "packed", "home", F.explode(F.sequence(F.coalesce("home", F.lit(0)), F.col("n") - 1)).alias("to")
    ).withColumn("own", F.coalesce(F.col("to") == F.col("home"), F.lit(False)))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, own, held, n_held = None, None, [], 0

        def links(a: np.ndarray, b: np.ndarray | None) -> Iterator[pa.RecordBatch]:
            x, y = spanning_links(a, b, radius)
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["a", "b"])

        for batch in batches:
            packed = batch.column("packed")
            values, ends = packed.values.to_numpy(zero_copy_only=False).view(np.uint64), packed.offsets.to_numpy()
            places = list(zip(*(batch.column(c).to_pylist() for c in (*names, "to"))))
            for i, is_own in enumerate(batch.column("own").to_pylist()):
                tile = values[ends[i] : ends[i + 1]]
                if is_own:
                    if held:
                        yield from links(own, np.concatenate(held))
                    place, own, held, n_held = places[i], tile.copy(), [], 0
                    yield from links(own, None)
                elif places[i] == place:
                    held.append(tile.copy())
                    n_held += len(tile)
                    if n_held >= tile_rows:
                        yield from links(own, np.concatenate(held))
                        held, n_held = [], 0
        if held:
            yield from links(own, np.concatenate(held))

    ordered = sent.select(*names, "to", "own", "packed").repartition(*names, "to")
    ordered = ordered.sortWithinPartitions(*names, "to", F.desc("own"))
    return ordered.mapInArrow(compare, "a long, b long")


def _components(marked: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """(bits, root): the component of every fingerprint of ``marked``."""
    prints = marked.select("bits").distinct()
    nodes = connected_components(fingerprint_links(prints, radius, tile_rows), "a", "b")
    return prints.join(nodes, prints["bits"] == nodes["node"], "left").select("bits", F.coalesce("component", "bits").alias("root"))


def simhash_components(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """(``key``, fingerprint, component_id) per row of ``docs``; other columns are not read.

    ``component_id`` is the smallest key among the rows that links of fingerprints with at most ``radius``
    differing bits reach, the row itself included; null keys count only where all are null. Null and empty
    texts have fingerprint zero and link like any other. Repeated rows come out each. An empty table gives no
    rows. Copies share a fingerprint and are compared once; a fingerprint that many rows share meets its
    component in a join that Spark can split.
    """
    marked = frozen(docs.select(F.col(key).alias("key"), fingerprints(F.col(text), shingle_words).alias("bits")))
    least = marked.groupBy("bits").agg(F.min("key").alias("least"))
    roots = _components(marked, radius, tile_rows).join(least, "bits")
    by_root = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    found = roots.join(by_root, "root").select("bits", "component_id")
    return marked.join(found, "bits").select(F.col("key").alias(key), as_hex(F.col("bits")).alias("fingerprint"), "component_id")


def drop_near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """``docs`` with one row of every component left: that with the smallest key, null last, and of rows with
    the same key that with the smallest hash of the text. Of rows alike in both, any one stays.

    Only keys and hashes are compared; the texts are shuffled once, to meet the keys that stay.
    """
    mark, zero = F.xxhash64(F.col(text)), F.lit(0).cast(docs.schema[key].dataType)
    marked = frozen(docs.select(F.col(key).alias("key"), mark.alias("mark"), fingerprints(F.col(text), shingle_words).alias("bits")))
    first = F.struct(F.col("key").isNull().alias("last"), "key", "mark")
    least = marked.groupBy("bits").agg(F.min(first).alias("least"))
    roots = _components(marked, radius, tile_rows).join(least, "bits")
    stays = roots.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.last").alias("_last"), F.coalesce("least.key", zero).alias("_key"), F.col("least.mark").alias("_mark"))
    # One shuffle of the texts serves the join and the window: the same columns, none of them null.
    rows = docs.withColumns({"_last": F.col(key).isNull(), "_key": F.coalesce(F.col(key), zero), "_mark": mark})
    rows = rows.join(stays, ["_last", "_key", "_mark"], "left_semi")
    alike = W.partitionBy("_last", "_key", "_mark").orderBy("_mark")
    return rows.withColumn("_place", F.row_number().over(alike)).filter("_place = 1").select(*docs.columns)
