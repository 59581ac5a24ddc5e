"""Near-duplicate detection by circulant MinHash, banding and exact Jaccard verification.

Two permutations make the whole signature (Li and Li, 2022): the first scrambles the shingles' positions in a universe
of 2^32, the second gives coordinate k as the least value at positions shifted circularly by k. Bands of four
coordinates propose pairs; with 24 bands a pair at similarity 0.8 is missed with chance (1 - 0.8^4)^24 = 3e-6, one at
0.85 with 2e-8. Pairs are confirmed on the full shingle sets.

Texts with the same words are one class from the start. A bucket of m classes is not turned into m^2 pairs: all members
are tried against two pivots, and links are joined into components. Members that share a bucket but lie in different
components after that are compared by their whole signatures, in blocks of bounded size inside the tasks. Those with a
partner that agrees within five standard deviations of the bound (1 in a million fall below) are compared by their full
sets, again in blocks, and a block gives a forest of links in place of all its pairs; no link between components is lost
but for that one in a million.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramline.llm.arrays import Words, mix64, plain_strings, slices
from gramline.llm.graph import components
from gramline.plans.lookup import lookup_join
from gramline.plans.storage import written

SHINGLE_WORDS = 4
PERCENT = 80
BANDS = 24
BAND_ROWS = 4
_COEFFICIENTS = [np.uint64(c) for c in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def shingles(words: Words, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text, 64-bit shingle), sorted by text: the different runs of n words of each text; fewer words are one run."""
    count, first = words.count, words.first[:-1]
    weights = [mix64(np.array([i + 1], np.uint64))[0] | np.uint64(1) for i in range(n)]
    owner = np.repeat(np.arange(len(count)), np.maximum(count - n + 1, 0))
    long_first = np.cumsum(np.maximum(count - n + 1, 0)) - np.maximum(count - n + 1, 0)
    at = np.arange(len(owner)) - long_first[owner] + first[owner]
    value = np.zeros(len(at), np.uint64)
    for i in range(n):
        value += words.key[at + i] * weights[i]
    short = np.flatnonzero((count > 0) & (count < n))
    whole = np.zeros(len(short), np.uint64)
    for i in range(n - 1):
        has = count[short] > i
        whole[has] += words.key[first[short][has] + i] * weights[i]
    whole ^= mix64(count[short].astype(np.uint64))
    owner, value = np.r_[owner, short], mix64(np.r_[value, whole])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])] if len(owner) else np.zeros(0, bool)
    return owner[new], value[new]


def _scramble(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(a)
    x ^= x >> np.uint32(13)
    x *= np.uint32(b)
    x ^= x >> np.uint32(16)
    return x


def circulant_signature(value: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Signatures (coordinate, text) of runs of shingles that begin at `starts`; every run has a shingle."""
    place = _scramble((value >> np.uint64(32)).astype(np.uint32), 0x85EBCA6B, 0xC2B2AE35)
    out = np.empty((size, len(starts)), np.uint32)
    for k in range(size):
        out[k] = np.minimum.reduceat(_scramble(place - np.uint32(k), 0x7FEB352D, 0x846CA68B), starts)
    return out


def _bands(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(text, band): a 64-bit key of each band's coordinates and number."""
    out = np.empty((signature.shape[1], bands), np.uint64)
    for b in range(bands):
        key = np.full(signature.shape[1], b + 1, np.uint64)
        for r in range(rows):
            key = mix64(key ^ signature[b * rows + r].astype(np.uint64) * _COEFFICIENTS[r % 4])
        out[:, b] = key
    return out.view(np.int64)


BLOCK_MEMBERS = 1000
BLOCK_SHINGLES = 1 << 20
SHARD_MEMBERS = 20_000
SALT_PAIRS = 1000
_SIGNED = "ref binary, doc_id long, words_key binary, n_shingles long, bands array<long>, signature binary"


def _sign(batches, n: int, bands: int, rows: int):
    for batch in batches:
        refs, ids, texts = batch.column(0), batch.column(1), plain_strings(batch.column(2))
        for first, data, offsets in slices(texts):
            size = len(offsets) - 1
            owner, value = shingles(Words(data, offsets), n)
            count = np.bincount(owner, minlength=size)
            full = np.flatnonzero(count)
            starts = (np.cumsum(count) - count)[full]
            keys, signatures = [None] * size, [None] * size
            if len(full):
                signature = circulant_signature(value, starts, bands * rows)
                for i, key, own in zip(full, _bands(signature, bands, rows), signature.T, strict=True):
                    keys[i], signatures[i] = key, own.tobytes()
            digests = []
            for d in range(size):
                normal = b" ".join(data[offsets[d] : offsets[d + 1]].tobytes().lower().split())
                digests.append(hashlib.blake2b(normal, digest_size=16).digest() if normal else None)
            yield pa.RecordBatch.from_arrays(
                [refs.slice(first, size), ids.slice(first, size), pa.array(digests, pa.binary()), pa.array(count),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(signatures, pa.binary())],
                ["ref", "doc_id", "words_key", "n_shingles", "bands", "signature"],
            )


def row_ref():
    """What names a row by its id and text; rows that agree in both share it."""
    text = F.concat_ws("\n", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))
    return F.unhex(F.md5(text))


def _linked(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose shingle sets are similar enough. A class found in more than SALT_PAIRS pairs is
    copied, so that no task gets all of them."""

    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        out = np.zeros(len(left), bool)
        for i, (x, y) in enumerate(zip(left, right, strict=True)):
            data = x.encode() + y.encode()
            middle = len(x.encode())
            words = Words(np.frombuffer(data, np.uint8), np.array([0, middle, len(data)]))
            owner, value = shingles(words, n)
            common = len(value) - len(np.unique(value))
            out[i] = 100 * common >= percent * (len(value) - common) and common > 0
        return pd.Series(out)

    for side, other in (("a", "b"), ("b", "a")):
        salts = F.ceil(F.col("n") / SALT_PAIRS).cast("long").alias(f"salts_{side}")
        heavy = pairs.groupBy(side).agg(F.count("*").alias("n")).filter(F.col("n") > SALT_PAIRS).select(side, salts)
        heavy = written(heavy, "heavy-classes")
        salted = lookup_join(pairs, heavy, [side], "left")
        pairs = salted.withColumn(f"salt_{side}", F.pmod(F.xxhash64(other), F.coalesce(f"salts_{side}", F.lit(1)))).drop(f"salts_{side}")
        own = lookup_join(texts.select(F.col("words_key").alias(side), F.col("text").alias(f"text_{side}")), heavy, [side], "left")
        copies = F.sequence(F.lit(0).cast("long"), F.coalesce(f"salts_{side}", F.lit(1)) - 1)
        own = own.withColumn(f"salt_{side}", F.explode(copies)).drop(f"salts_{side}")
        pairs = pairs.join(own, [side, f"salt_{side}"])
    return pairs.filter(similar("text_a", "text_b")).select("a", "b")


def near_duplicates(docs: DataFrame, n: int = SHINGLE_WORDS, percent: int = PERCENT, bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """(ref, doc_id, n_shingles, component_id, kept): one row per document.

    Words are runs of other than space and \\t to \\r, A-Z lower-cased; a document's set is its different runs of `n`
    words. Documents are linked if 100 * intersection >= percent * union; `component_id` is the smallest id reachable,
    its own included. A text without words (null, empty, white space) has no shingles and is linked with nothing. Rows
    that share an id are rows of their own. Rows without an id link others, but give no component an id: where no row
    has one it is null and all such rows are kept. Other columns are not read.
    """
    source = docs.select(row_ref().alias("ref"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = written(source.mapInArrow(lambda b: _sign(b, n, bands, band_rows), _SIGNED), "signatures")
    classes = written(
        rows.filter("words_key IS NOT NULL").groupBy("words_key").agg(
            F.min("doc_id").alias("least_id"), F.min("ref").alias("ref"), F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"), F.first("signature").alias("signature"),
        ), "classes",
    )
    members = classes.select(F.explode("bands").alias("band"), F.struct("words_key", "n_shingles").alias("one"))
    pivots = members.groupBy("band").agg(F.min("one").alias("low"), F.max("one").alias("high"))
    shared = written(members.join(pivots.filter("low != high"), "band"), "buckets")

    def pair(x: str, y: str):
        return F.least(f"{x}.words_key", f"{y}.words_key").alias("a"), F.greatest(f"{x}.words_key", f"{y}.words_key").alias("b")

    def close(x: str, y: str):
        few, many = F.least(f"{x}.n_shingles", f"{y}.n_shingles"), F.greatest(f"{x}.n_shingles", f"{y}.n_shingles")
        return (100 * few >= percent * many) & (F.col(f"{x}.words_key") != F.col(f"{y}.words_key"))

    tried = written(
        shared.filter(close("one", "low")).select(*pair("one", "low"))
        .unionByName(shared.filter(close("one", "high")).select(*pair("one", "high"))).distinct(), "pairs",
    )
    texts = _texts_of(source, classes, tried.select(F.explode(F.array("a", "b")).alias("words_key")))
    links = written(_linked(tried, texts, n, percent), "links")
    roots = components(links, "a", "b")

    more = _missed(source, shared, classes, roots, n, percent)
    if more is not None:
        roots = _merged(roots, more)
    named = classes.select("words_key", "least_id").join(roots.withColumnRenamed("node", "words_key"), "words_key", "left")
    named = written(named.withColumn("root", F.coalesce("root", "words_key")), "classes")
    ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    known = named.select("words_key", "root").join(ids, "root").select("words_key", "component_id")
    out = rows.drop("bands", "signature").join(known, "words_key", "left")
    own = F.when(F.col("words_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "ref", "doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept")
    )


def _merged(roots: DataFrame, more: DataFrame) -> DataFrame:
    """`roots` after further links (a, b): only the roots that these join are walked again, not all links."""
    at = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root"))
    ends = more.join(at("a"), "a", "left").join(at("b"), "b", "left")
    ends = ends.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
    above = written(components(ends, "a", "b"), "merged-roots")
    sizes = roots.groupBy("root").agg(F.count("*").alias("n"))
    table = above.select(F.col("node").alias("root"), F.col("root").alias("above")).join(sizes, "root", "left")
    table = written(table.fillna(1, ["n"]), "merged-sizes")
    moved = lookup_join(roots.select("node", "root"), table, ["root"], "left", weight="n")
    alone = above.join(roots.select("node"), "node", "left_anti")
    return moved.select("node", F.coalesce("above", "root").alias("root")).unionByName(alone.select("node", "root"))


def _texts_of(source: DataFrame, classes: DataFrame, keys: DataFrame) -> DataFrame:
    """(words_key, text) of one document of every class in the keys."""
    refs = classes.select("words_key", "ref").join(keys.distinct(), "words_key")
    found = source.select("ref", "text").join(refs, "ref").select("words_key", "text")
    return written(found.groupBy("words_key").agg(F.first("text").alias("text")), "pair-texts")


def _units(placed: DataFrame) -> DataFrame:
    """(band, low, high, own, words_key, n_shingles, root): the members (band, words_key, n_shingles, root) of buckets
    that hold several components, once for each unit of work, a pair of blocks, that they take part in.

    Members of a bucket's largest component share no open pair. They and the rest are cut apart into blocks of at most
    about BLOCK_MEMBERS members and BLOCK_SHINGLES shingles; the rest's blocks meet each other and those of the
    largest component, which do not meet among themselves. So beside a few strays a component of any size costs a row
    per member.
    """

    def blocks(members, many):
        return F.ceil(F.greatest(members / BLOCK_MEMBERS, many / BLOCK_SHINGLES)).cast("long")

    sizes = placed.groupBy("band", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("many"))
    buckets = sizes.groupBy("band").agg(
        F.max(F.struct("n", "root", "many")).alias("most"), F.sum("n").alias("members"), F.sum("many").alias("many")
    ).filter("most.n < members AND members > 2")
    buckets = buckets.select(
        "band", "members", F.col("most.root").alias("main"), blocks(F.col("most.n"), F.col("most.many")).alias("main_blocks"),
        blocks(F.col("members") - F.col("most.n"), F.col("many") - F.col("most.many")).alias("rest_blocks"),
    )
    rows = lookup_join(placed, written(buckets, "mixed-buckets"), ["band"], weight="members")
    of_main, place = F.col("root") == F.col("main"), F.xxhash64("words_key")
    own = F.when(of_main, F.col("rest_blocks") + F.pmod(place, "main_blocks")).otherwise(F.pmod(place, "rest_blocks"))
    met = F.when(of_main, F.col("rest_blocks")).otherwise(F.col("rest_blocks") + F.col("main_blocks"))
    copies = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), met - 1)))
    low, high = F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    return written(copies.select("band", low, high, "own", "words_key", "n_shingles", "root"), "units")


def _missed(source: DataFrame, shared: DataFrame, classes: DataFrame, roots: DataFrame, n: int, percent: int) -> DataFrame | None:
    """Links (a, b) between classes in a common bucket whose components differ so far; None if there is nothing to try.

    Signatures choose the members of a unit (see `_units`) that may have a link there; those are compared by their full
    sets, and a unit gives as many links as join its members, never all its pairs.
    """
    placed = shared.select("band", "one.words_key", "one.n_shingles", F.col("one.words_key").alias("node")).join(roots, "node", "left")
    placed = written(placed.select("band", "words_key", "n_shingles", F.coalesce("root", "node").alias("root")), "placed")
    units = _units(placed)
    n_shards = max(1, -(-units.count() // SHARD_MEMBERS))
    units = units.join(classes.select("words_key", "signature", "bands"), "words_key")
    shard = F.pmod(F.xxhash64("band", "low", "high"), F.lit(n_shards)).alias("shard")
    chosen = written(
        units.select(shard, "*").groupBy("shard").applyInPandas(
            lambda f: _promising(f, percent), "band long, low long, high long, words_key binary, root binary"
        ), "promising",
    )
    if not chosen.take(1):
        return None

    @F.pandas_udf("binary")
    def shingle_set(texts: pd.Series) -> pd.Series:
        data = [t.encode() for t in texts]
        return pd.Series([shingles(Words(np.frombuffer(d, np.uint8), np.array([0, len(d)])), n)[1].tobytes() for d in data])

    texts = _texts_of(source, classes, chosen.select("words_key"))
    sets = written(texts.select("words_key", shingle_set("text").alias("shingles")), "shingle-sets")
    found = chosen.join(sets, "words_key").groupBy("band", "low", "high").applyInPandas(
        lambda f: _spanning(f, percent), "a binary, b binary"
    )
    return written(found, "links")


def _agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(row of x, row of y): in how many coordinates two signatures agree."""
    if len(x) * len(y) < 1 << 12:
        return (x[:, None, :] == y[None, :, :]).sum(2)
    out = np.zeros((len(x), len(y)), np.uint16)
    for left, right in zip(np.ascontiguousarray(x.T), np.ascontiguousarray(y.T), strict=True):
        out += left[:, None] == right
    return out


def _promising(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """The members of each unit with a partner in it, in another component, whose signature agrees often enough. A pair
    counts in the first bucket that it shares."""
    frame = frame.sort_values(["band", "low", "high"], kind="stable", ignore_index=True)
    place = frame[["band", "low", "high"]].to_numpy(np.int64)
    begin = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]).any(1)])
    signature = np.stack([np.frombuffer(x, np.uint32) for x in frame["signature"]])
    bands = np.stack(list(frame["bands"]))
    n, root = frame["n_shingles"].to_numpy(np.int64), pd.factorize(frame["root"].map(bytes))[0]
    own, bound, size = frame["own"].to_numpy(np.int64), percent / 100, signature.shape[1]
    least = size * (bound - 5 * np.sqrt(bound * (1 - bound) / size))
    take = np.zeros(len(frame), bool)
    for a, b in zip(begin, np.r_[begin[1:], len(frame)], strict=True):
        band, low, high = place[a]
        x = a + np.flatnonzero(own[a:b] == low)
        y = x if low == high else a + np.flatnonzero(own[a:b] == high)
        few, many = np.minimum(n[x][:, None], n[y]), np.maximum(n[x][:, None], n[y])
        open_ = (root[x][:, None] != root[y]) & (100 * few >= percent * many)
        if not open_.any():
            continue
        i, j = np.nonzero(open_ & (_agreement(signature[x], signature[y]) >= least))
        for at in range(0, len(i), 1 << 16):
            left, right = x[i[at : at + (1 << 16)]], y[j[at : at + (1 << 16)]]
            first = (bands[left] == bands[right]).argmax(1)
            here = bands[left, first] == band
            take[left[here]] = take[right[here]] = True
    return frame.loc[take, ["band", "low", "high", "words_key", "root"]]


def _spanning(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between the members of a unit, decided on full sets, as a forest that joins what the links join."""
    keys, root = frame["words_key"].to_numpy(), pd.factorize(frame["root"].map(bytes))[0]
    sets = [np.frombuffer(x, np.uint64) for x in frame["shingles"]]
    n = np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(len(n)), n)
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times[code] > 1
    column, owner = (np.cumsum(times > 1) - 1)[code[common]], owner[common]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((len(n), len(n)), np.float32)  # whole numbers below 2^24, so exact
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        lo, hi = np.searchsorted(column, [at, at + 4096])
        has = np.zeros((len(n), 4096), np.float32)
        has[owner[lo:hi], column[lo:hi] - at] = 1
        both += has @ has.T
    both = both.astype(np.int64)
    linked = (100 * both >= percent * (n[:, None] + n - both)) & (both > 0) & (root[:, None] != root)
    seen, out = np.zeros(len(n), bool), []
    for start in range(len(n)):
        waiting = [] if seen[start] else [start]
        seen[start] = True
        while waiting:
            at = waiting.pop()
            new = np.flatnonzero(linked[at] & ~seen)
            seen[new] = True
            waiting.extend(new.tolist())
            out.extend((keys[at], keys[i]) for i in new)
    return pd.DataFrame(out, columns=["a", "b"])
