"""Removal of repeated strings: blockwise suffix ranking with a difference cover."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import staged

from .base import query, table
from .hashing import BLOCK, BYTE_CODES, Stretches, mixed

LENGTH = 400  # bytes of a string that must not occur twice
ORDER = 13  # prime; the cover has ORDER + 1 of every ORDER**2 + ORDER + 1 positions
BUCKET_BYTES = 1 << 25  # text whose samples one bucket takes
PILE = 1 << 24  # bytes of text a task turns into one row per bucket
SENT_ROWS, SENT_BYTES = 2_000_000, 1 << 25  # ids, or removed runs, that are broadcast; more are joined by a shuffle
BLOB = "bucket int, keys binary, counts binary, names binary, places binary"  # or, in a bucket below 0, keys and the runs found for each
_GOLD = np.uint64(0x9E3779B97F4A7C15)


@cache
def difference_cover(order: int = ORDER) -> tuple[int, tuple[int, ...]]:
    """Period v and a set D of residues such that every difference modulo v is one of two members of D.

    Points of a line in the projective plane over the integers modulo a prime:
    powers x**i modulo a cubic whose quadratic coefficient vanishes (i < v).
    The cubic is searched; the property itself is checked.
    """
    period = order * order + order + 1
    for a in range(order):
        for b in range(order):
            for c in range(1, order):
                low, mid, high = 1, 0, 0
                found = []
                for i in range(period):
                    if not high:
                        found.append(i)
                    low, mid, high = high * c % order, (low + high * b) % order, (mid + high * a) % order
                if len(found) == order + 1 and len({(x - y) % period for x in found for y in found}) == period:
                    return period, tuple(found)
    raise ValueError(f"{order} is not a prime")


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def sample_names(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Names (hashes) and positions of the sampled suffixes.

    A sampled suffix starts at a position of the cover and is named by its first
    length - v + 1 bytes.  Two equal strings of ``length`` bytes have sampled
    suffixes at equal offsets below v, and those names lie inside the strings.
    """
    period, cover = difference_cover()
    size = length - period + 1
    names, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    if len(data) >= length:
        offsets = np.array(cover)
        for start in range(0, len(data) - size + 1, BLOCK):
            end = min(start + BLOCK, len(data) - size + 1)
            first = start // period
            at = ((first + np.arange((end - start) // period + 2))[:, None] * period + offsets).ravel()
            at = at[(at >= start) & (at < end)]
            names.append(Stretches(BYTE_CODES[data[start : end + size - 1]]).at(at - start, size))
            places.append(at)
    return np.concatenate(names), np.concatenate(places)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edges[::2], edges[1::2]


def candidate_runs(places: np.ndarray, size: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of starts whose string of ``length`` bytes holds a repeated sample below offset v."""
    period, _ = difference_cover()
    places = np.sort(places)
    low, high = np.maximum(places - period + 1, 0), np.minimum(places, size - length) + 1
    low, high = low[high > low], high[high > low]
    if not len(low):
        return low, high
    new = np.concatenate(([True], low[1:] > high[:-1]))  # both ascend
    return low[new], high[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(low) - 1]))]


def suffix_names(data: np.ndarray, low: int, high: int, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """For the suffixes that start in [low, high): blocks of first position and names of ``length`` bytes."""
    for start in range(low, high, BLOCK):
        end = min(high, start + BLOCK)
        yield start, Stretches(BYTE_CODES[data[start : end + length - 1]]).all(length)


def _blobs(bucket: np.ndarray, key: np.ndarray, names: np.ndarray, places: np.ndarray, packed) -> pd.DataFrame:
    """One row per bucket; within a bucket rows keep their order, by text and place.  ``packed`` turns its rows into the two last columns."""
    order = np.argsort(bucket.astype(np.uint16) if len(bucket) and bucket.max() < 1 << 16 else bucket, kind="stable")
    bucket, key, names, places = bucket[order], key[order], names[order], places[order]
    new_bucket = np.append(True, bucket[1:] != bucket[:-1]) if len(bucket) else np.zeros(0, bool)
    # texts of a bucket: where the text or the bucket changes
    firsts = np.flatnonzero(new_bucket | np.append(True, key[1:] != key[:-1])) if len(bucket) else np.zeros(0, np.int64)
    counts = np.diff(np.append(firsts, len(key))).astype(np.int32)
    cuts = np.flatnonzero(new_bucket)
    ends = np.append(cuts[1:], len(bucket))
    texts = np.searchsorted(firsts, np.append(cuts, len(bucket)))
    rows = []
    for n, (low, high) in enumerate(zip(cuts.tolist(), ends.tolist(), strict=True)):
        own = slice(texts[n], texts[n + 1])
        rows.append((int(bucket[low]), key[firsts[own]].astype(np.int64).tobytes(), counts[own].tobytes(), *packed(names[low:high], places[low:high])))
    return pd.DataFrame(rows, columns=["bucket", "keys", "counts", "names", "places"])


def _as_steps(places: np.ndarray) -> bytes:
    return np.diff(places, prepend=0).astype(np.int32).tobytes()  # small numbers, which compress well


def _repeated(names: np.ndarray, keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which suffixes have a name that starts at two different places; copies of a text count as one place.

    And which suffixes tell others as much as all of them: one of each name, or two at different places.
    """
    found, telling = np.zeros(len(names), bool), np.zeros(len(names), bool)
    if not len(names):
        return found, telling
    spots = mixed(keys.astype(np.uint64) ^ (places.astype(np.uint64) * _GOLD))
    order = np.argsort(names)
    ranked = names[order]
    starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    sizes = np.diff(np.append(starts, len(names)))
    telling[order[starts]] = True
    several = sizes > 1
    if several.any():
        starts, sizes = starts[several], sizes[several]
        own = np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)  # ranks of names met more than once
        other = spots[order[own]] != np.repeat(spots[order[starts]], sizes)
        groups = np.append(0, np.cumsum(sizes)[:-1])
        last = np.maximum.reduceat(np.where(other, own, -1), groups)
        different = last >= 0
        found[order[own]] = np.repeat(different, sizes)
        telling[order[last[different]]] = True
    return found, telling


def _runs_of(keys: np.ndarray, places: np.ndarray) -> list[tuple[int, bytes]]:
    """Per text its places, as runs."""
    if not len(keys):
        return []
    order = np.lexsort((places, keys))
    keys, places = keys[order], places[order]
    new_key = np.append(True, keys[1:] != keys[:-1])
    once = new_key | np.append(True, places[1:] != places[:-1])
    keys, places, new_key = keys[once], places[once], new_key[once]
    firsts = np.flatnonzero(new_key | np.append(True, np.diff(places) != 1))  # of runs
    starts, lengths = places[firsts].astype(np.int32), np.diff(np.append(firsts, len(places))).astype(np.int32)
    cuts = np.flatnonzero(new_key)
    ends = np.searchsorted(firsts, np.append(cuts, len(keys)))
    return [(key, starts[a:b].tobytes() + lengths[a:b].tobytes()) for key, a, b in zip(keys[cuts].tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _settled(bucket: np.ndarray, key: np.ndarray, names: np.ndarray, places: np.ndarray, buckets: int, packed) -> pd.DataFrame:
    """The rows of one pile: what it finds repeated by itself, and for the buckets at most two suffixes of each name.

    So a bucket takes two suffixes of a name from a pile, however many copies the pile holds.
    """
    found, telling = _repeated(names, key, places)
    own = _runs_of(key[found], places[found])
    blobs = _blobs(bucket[telling], key[telling], names[telling], places[telling], packed)
    if not own:
        return blobs
    # by text, so that answers spread as texts do
    rows = [(-1 - k % buckets, np.array([k], np.int64).tobytes(), b"", b"", runs) for k, runs in own]
    return pd.concat([blobs, pd.DataFrame(rows, columns=blobs.columns)], ignore_index=True)


def _answer(kind):
    """Rank one bucket of suffixes by their names and return, per text, the runs of repeated places."""

    def rank(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["bucket"].iloc[0] < 0:  # found in piles
            keys = [np.frombuffer(k, np.int64)[0] for k in rows["keys"]]
            parts = [np.frombuffer(b, np.int32) for b in rows["places"]]
            starts, lengths = (np.concatenate([p[i * len(p) // 2 : (i + 1) * len(p) // 2] for p in parts]).astype(np.int64) for i in range(2))
            owner = np.repeat(np.array(keys, np.int64), [len(p) // 2 for p in parts])
            places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
            return pd.DataFrame(_runs_of(np.repeat(owner, lengths), places), columns=["key", "runs"])
        names, keys, places = [], [], []
        for row in rows.itertuples(index=False):
            counts = np.frombuffer(row.counts, np.int32)
            names.append(np.frombuffer(row.names, kind))
            keys.append(np.repeat(np.frombuffer(row.keys, np.int64), counts))
            places.append(np.cumsum(np.frombuffer(row.places, np.int32), dtype=np.int64))
        names, keys, places = map(np.concatenate, (names, keys, places))
        found, _ = _repeated(names, keys, places)
        return pd.DataFrame(_runs_of(keys[found], places[found]), columns=["key", "runs"])

    return rank


def _union(blobs: list[bytes]) -> np.ndarray:
    """All places of some lists of runs, ascending, once each."""
    parts = [np.frombuffer(b, np.int32) for b in blobs]
    starts = np.concatenate([p[: len(p) // 2] for p in parts]).astype(np.int64)
    lengths = np.concatenate([p[len(p) // 2 :] for p in parts]).astype(np.int64)
    order = np.argsort(starts)
    starts, ends = starts[order], np.maximum.accumulate((starts + lengths)[order])
    starts[1:] = np.maximum(starts[1:], ends[:-1])  # what an earlier run holds already is left out
    lengths = np.maximum(0, ends - starts)
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)


def removed_runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, low, high): per distinct text the byte runs that repeated strings cover.

    ``key`` is xxhash64 of the text; ``low`` and ``high`` (ends exclusive) are arrays.

    1. Samples: suffixes at the cover positions of every text are named by their
       first bytes, dealt to buckets, and ranked one bucket at a time; a repeated name
       is what remains of them.  A bucket takes what ``BUCKET_BYTES`` of text give.
       A task settles piles of ``PILE`` bytes by itself first and passes on at most two
       suffixes of a name, so copies of a passage don't gather in one bucket.
    2. Suffixes that may tie over ``length`` bytes are those just before a repeated
       sample.  They too go to buckets and are ranked one bucket at a time, by
       the name of their first ``length`` bytes: only equality over these bytes
       matters here, so deeper ranks are never needed.
    3. A text that occurs twice repeats as a whole; only one copy takes part in 2.

    Buckets are packed rows of bounded size, keyed by content: a task that runs
    again after a loss gives the same rows.  Equality is that of 64-bit names.
    """
    period, _ = difference_cover()
    texts = docs.select(F.xxhash64("text").alias("key"), F.coalesce("doc_id", F.lit(-1)).cast("long").alias("id"), "text")
    texts = texts.where(F.octet_length("text") >= length)
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 << max(6, (total // BUCKET_BYTES).bit_length())

    def sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pile, seen, size = [], set(), 0

        def flushed() -> pd.DataFrame:
            key, names, places = (np.concatenate([p[i] for p in pile]) for i in range(3))
            bits = np.uint64(buckets.bit_length() - 1)
            bucket = (names >> (np.uint64(64) - bits)).astype(np.int64)
            low = lambda n: (n >> (np.uint64(32) - bits)).astype(np.uint32)  # noqa: E731 - the 32 bits below those of the bucket
            return _settled(bucket, key, names, places, buckets, lambda n, p: (low(n).tobytes(), _as_steps(p)))

        for batch in batches:
            for key, text in zip(batch["key"], batch["text"], strict=True):
                if key in seen:
                    continue
                seen.add(key)
                data = _bytes(text)
                names, places = sample_names(data, length)
                pile.append((np.full(len(names), key, np.int64), names, places))
                size += len(data)
                if size > PILE:
                    yield flushed()
                    pile, seen, size = [], set(), 0
        if pile:
            yield flushed()

    answer = _answer(np.uint32)
    samples = texts.select("key", "text").mapInPandas(sampled, BLOB).groupBy("bucket").applyInPandas(answer, "key long, runs binary")
    # at most one row per bucket and text; a text's rows are its own samples
    samples = staged(samples.groupBy("key").agg(F.collect_list("runs").alias("runs")), "repeated-samples")

    classes = texts.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    wanted = samples.join(classes.select("key", "id"), "key").select("key", "id", "runs")
    hint = F.broadcast if samples.count() <= SENT_ROWS else (lambda df: df)
    texts = texts.join(hint(wanted.select("key", "id")), ["key", "id"], "left_semi").join(samples, "key")

    def suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pile, size = [], 0

        def flushed() -> pd.DataFrame:
            key, names, places = (np.concatenate([p[i] for p in pile]) for i in range(3))
            # by name: neighbours of a passage's copies, all different, spread too
            bucket = (names >> np.uint64(64 - buckets.bit_length() + 1)).astype(np.int64)
            return _settled(bucket, key, names, places, buckets, lambda n, p: (n.tobytes(), _as_steps(p)))

        for batch in batches:
            for key, text, runs in zip(batch["key"], batch["text"], batch["runs"], strict=True):
                data = _bytes(text)
                for low, high in zip(*candidate_runs(_union(list(runs)), len(data), length), strict=True):
                    for start, names in suffix_names(data, int(low), int(high), length):
                        pile.append((np.full(len(names), key, np.int64), names, start + np.arange(len(names))))
                        size += len(names)
                        if size > PILE // 8:
                            yield flushed()
                            pile, size = [], 0
        if pile:
            yield flushed()

    answer = _answer(np.uint64)
    found = texts.select("key", "text", "runs").mapInPandas(suffixes, BLOB).groupBy("bucket").applyInPandas(answer, "key long, runs binary")
    found = found.groupBy("key").agg(F.collect_list("runs").alias("runs"))

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, runs in zip(batch["key"], batch["runs"], strict=True):
                starts = _union(list(runs))
                new = np.concatenate(([True], np.diff(starts) > length))
                rows.append((key, starts[new].tolist(), (starts[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(starts) - 1]))] + length).tolist()))
            yield pd.DataFrame(rows, columns=["key", "low", "high"])

    covered = found.mapInPandas(cover, "key long, low array<long>, high array<long>")
    copies = classes.where("n > 1").select("key")
    whole = copies.select("key", F.array(F.lit(0).cast("long")).alias("low"), F.array(F.lit(2**62)).alias("high"))
    return staged(whole.union(covered.join(copies, "key", "left_anti")), "removed-runs")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of (doc_id, text): the bytes, what is removed, and the digest of what is left.

    Every byte covered by a string of ``length`` bytes that starts anywhere else too is
    removed, overlaps included, judged on the input.  A null text is empty; a
    text shorter than ``length`` keeps all; of equal texts nothing is kept if
    they are long enough; repeated rows and equal or null ids are texts like others.
    """
    runs = removed_runs(docs, length)
    seen = runs.agg(F.count("*").alias("n"), F.sum(F.size("low")).alias("runs")).first()
    small = 40 * seen["n"] + 16 * (seen["runs"] or 0) <= SENT_BYTES
    rows = docs.select(F.xxhash64("text").alias("key"), "doc_id", "text").join(F.broadcast(runs) if small else runs, "key", "left")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, low, high in zip(batch["text"], batch["low"], batch["high"], strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                pairs = [] if low is None or len(data) < length else [(int(a), min(int(b), len(data))) for a, b in zip(low, high, strict=True)]
                digest, at = hashlib.sha256(), 0
                for start, end in pairs:
                    digest.update(data[at:start])
                    at = end
                digest.update(data[at:])
                out.append((len(data), sum(b - a for a, b in pairs), len(pairs), digest.hexdigest()))
            result = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True).astype("Int64"), result], axis=1)

    return rows.select("doc_id", "text", "low", "high").mapInPandas(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


@query()
def op10_suffix_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the strings of 400 bytes that occur elsewhere."""
    return remove_repeats(table(spark, sf_dir, "documents"))
