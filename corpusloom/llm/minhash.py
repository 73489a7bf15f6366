"""Near-duplicates by MinHash with odd sketches, every link confirmed on the full sets.

1. Each document becomes its set of word shingles. Documents of equal sets (by a 128-bit fingerprint of
   the set) collapse to the one of smallest id, so copies cost no pairs.
2. ``bands`` x ``rows`` MinHash values; documents that agree on a band share a bucket. At similarity 0.8,
   28 x 4 values miss a pair with probability 4e-7.
3. The MinHash samples are folded into a parity bitmap, the odd sketch. The population count m of two
   bitmaps' XOR estimates the similarity as 1 + n / (4k) ln(1 - 2m / n), most precisely where it is high;
   candidates far below the threshold are dropped before any text moves.
4. Each document is first compared with the smallest document of its buckets that the sketch lets pass.
   Then, in buckets that still hold several components, all remaining pairs across components are tried, in
   blocks. No bucket, partner or candidate is capped.
5. Links are confirmed with whole-number arithmetic on the full shingle sets; components are found with
   joins over the links.

Defined cases: a document without words (or text) has an empty set and no links; one with fewer words
than a shingle has its whole sequence as its one shingle; rows of equal id and text are copies of each
other; rows of equal id and other texts are versions of one document, which any of its texts links; a null
id takes no part: its row comes back with a null component and is kept; an empty table gives an empty result; extra columns are ignored by :func:`near_duplicates` and kept by :func:`keep_one`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import ship
from . import kernels as K
from .common import materialise, parts_for
from .components import connected_components

U64 = np.uint64
BITS = 50  # of a shingle's hash; the other 14 bits of a sort key number the document within a slice
BANDS, ROWS, SKETCH_BITS = 28, 4, 256
LEAST_ESTIMATE = 0.3  # below the similarity threshold: drops a pair at 0.8 with probability 1e-7
_rng = np.random.default_rng(5)
_A = (_rng.integers(0, 1 << 31, BANDS * ROWS, dtype=np.int64) * 2 + 1).astype(np.uint32)
_B = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.int64).astype(np.uint32)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all documents (at most 2^14), and document offsets into them."""
    n = len(offsets) - 1
    data = K.lower_ascii(data)
    start, end, docs = K.words(data, offsets)
    prefix = K.Prefix(K.word_hashes(data, start, end))
    count = np.diff(docs)
    many = np.maximum(count - width + 1, np.minimum(count, 1))  # shingles with repeats
    first = K.ranges(docs[:-1], many)
    size = np.repeat(np.minimum(count, width), many)
    owner = np.repeat(np.arange(n, dtype=U64), many)
    key = np.unique((owner << U64(BITS)) | (prefix.slices(first, first + size) >> U64(64 - BITS)))
    return key & U64((1 << BITS) - 1), np.searchsorted(key >> U64(BITS), np.arange(n + 1, dtype=U64))


def signatures(shingles: np.ndarray, offsets: np.ndarray):
    """Fingerprint (two longs), band hashes and odd sketch of each set; sets may be empty."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    full = np.flatnonzero(size)
    at = offsets[:-1][full]
    wide = K.mix(shingles)
    one, two = np.zeros(n, U64), np.zeros(n, U64)
    bands, sketch = np.zeros((n, BANDS), U64), np.zeros((n, SKETCH_BITS // 8), np.uint8)
    if len(full):
        one[full], two[full] = np.add.reduceat(wide, at), np.add.reduceat(K.mix(wide ^ U64(0x5bd1e995)), at)
        base = (wide >> U64(32)).astype(np.uint32)
        parity = np.zeros((len(full), SKETCH_BITS), np.uint8)
        rows = np.arange(len(full))
        for j in range(BANDS * ROWS):
            least = np.minimum.reduceat(base * _A[j] + _B[j], at).astype(U64)
            parity[rows, (K.mix(least + U64(j << 32)) % U64(SKETCH_BITS)).astype(np.int64)] ^= 1
            b = j // ROWS
            bands[full, b] = K.mix(bands[full, b] * U64(0x9E3779B97F4A7C15) + least + U64(j + 1))
        sketch[full] = np.packbits(parity, axis=1)
    return one.view(np.int64), two.view(np.int64), bands.view(np.int64), sketch


def estimate(differ: np.ndarray, samples: int = BANDS * ROWS, bits: int = SKETCH_BITS) -> np.ndarray:
    """Similarity from the number of differing sketch bits."""
    return 1 + bits / (4 * samples) * np.log(np.maximum(1 - 2 * differ / bits, 1e-9))


def _sign(width: int):
    def run(batches):
        K.tame_memory()
        for batch in batches:
            data, offsets = K.buffers(batch.column(1))
            for i, j in K.doc_slices(offsets, 1 << 18):
                for s in range(i, j, 1 << 14):
                    e = min(j, s + (1 << 14))
                    sets, at = shingle_sets(data[offsets[s] : offsets[e]], offsets[s : e + 1] - offsets[s], width)
                    one, two, bands, sketch = signatures(sets, at)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, BANDS * (e - s) + 1, BANDS), pa.int32()), pa.array(bands.reshape(-1)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(s, e - s), pa.array(np.diff(at)), pa.array(one), pa.array(two), lists, pa.array([r.tobytes() for r in sketch], pa.binary())], ["id", "n", "f1", "f2", "bands", "sketch"])

    return run


def _squeeze(batches):
    """Texts as zstd frames, before they are shuffled."""
    K.tame_memory()
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        data, offsets = K.buffers(batch.column(1))
        view = memoryview(data)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([press.compress(view[s:e]) for s, e in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())], ["id", "z"])


CONFIRM_BYTES = 4 << 20


def _confirm(width: int, percent: int):
    """Keeps the pairs whose sets pass 100 |A & B| >= percent |A | B|. A text is shingled once in a slice, however many pairs it has."""

    def judge(left: list[bytes], right: list[bytes]) -> np.ndarray:
        unpress = zstandard.ZstdDecompressor()
        place: dict[bytes, int] = {}
        a, b = (np.array([place.setdefault(z, len(place)) for z in side], np.int64) for side in (left, right))
        texts = [unpress.decompress(z) for z in place]
        sets, at = shingle_sets(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]), width)
        size = np.diff(at)
        # both sets of each pair under the pair's number: what is common occurs twice
        key = [(np.repeat(np.arange(len(a), dtype=U64), size[x]) << U64(BITS)) | sets[K.ranges(at[x], size[x])] for x in (a, b)]
        key = np.sort(np.concatenate(key))
        common = np.bincount((key[1:][key[1:] == key[:-1]] >> U64(BITS)).astype(np.int64), minlength=len(a))
        union = size[a] + size[b] - common
        return (union > 0) & (100 * common >= percent * union)

    def run(batches):
        K.tame_memory()
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            weight = np.concatenate([[0], np.cumsum([4 * (len(x) + len(y)) for x, y in zip(left, right, strict=True)])])
            keep, s = [np.zeros(0, bool)], 0
            while s < len(left):
                e = min(max(s + 1, int(np.searchsorted(weight, weight[s] + CONFIRM_BYTES, "right")) - 1), s + (1 << 12))
                keep.append(judge(left[s:e], right[s:e]))
                s = e
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(np.concatenate(keep)))

    return run


def _close(x: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b, na, nb, sa, sb`` that sizes and sketches let pass; ``a, b``. Native: XOR by 64-bit words."""
    differ = sum((F.bit_count(F.conv(F.substring(F.hex("sa"), i, 8), 16, 10).cast("long").bitwiseXOR(F.conv(F.substring(F.hex("sb"), i, 8), 16, 10).cast("long"))) for i in range(1, SKETCH_BITS // 4, 8)), F.lit(0))
    most = int(np.flatnonzero(estimate(np.arange(SKETCH_BITS // 2)) >= percent / 100 - LEAST_ESTIMATE)[-1])
    sizes = (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)
    return x.where(sizes).where(differ <= most).select("a", "b")


def _across(percent: int):
    """Of the documents of one part: pairs in one bucket and different components that pass sizes and sketches."""
    most = int(np.flatnonzero(estimate(np.arange(SKETCH_BITS // 2)) >= percent / 100 - LEAST_ESTIMATE)[-1])

    def run(table: pa.Table) -> pa.Table:
        K.tame_memory()
        cell, side = table.column("cell").to_numpy(), table.column("side").to_numpy()
        ids, comp, n = (table.column(c).to_numpy() for c in ("id", "component", "n"))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(ids), -1)
        order = np.lexsort((ids, cell))
        heads = np.flatnonzero(np.concatenate([[True], cell[order][1:] != cell[order][:-1]]))
        out_a, out_b = [], []
        for s, e in zip(heads, np.append(heads[1:], len(order)), strict=True):
            rows = order[s:e]
            left, right = rows[side[rows] != 2], rows[side[rows] != 1]  # side 0: a block against itself
            for i in left:
                j = right[(comp[right] != comp[i]) & (100 * n[right] >= percent * n[i]) & (100 * n[i] >= percent * n[right])]
                if len(j):
                    j = j[np.bitwise_count(sketch[j] ^ sketch[i]).sum(1) <= most]
                    out_a.append(np.minimum(ids[i], ids[j]))
                    out_b.append(np.maximum(ids[i], ids[j]))
        z = np.zeros(0, np.int64)
        pairs = np.unique(np.stack([np.concatenate([z, *out_a]), np.concatenate([z, *out_b])]), axis=1)
        return pa.table({"a": pairs[0], "b": pairs[1]})

    return run


def _links(docs: DataFrame, width: int, percent: int, block: int):
    """``signs`` (id, n, f1, f2), ``reps`` (rep, n, f1, f2) and the component of each linked representative."""
    ship(docs.sparkSession)
    signs = materialise(docs.mapInArrow(_sign(width), "id long, n long, f1 long, f2 long, bands array<long>, sketch binary"), "minhash-signs")
    reps = signs.where("n > 0").groupBy("n", "f1", "f2").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    reps = materialise(reps, "minhash-reps")
    # a bucket's name is its band hash, which includes the band's number
    spread = reps.select("rep", F.explode("bands").alias("bucket"))
    full = spread.groupBy("bucket").agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("members")).where("members > 1")
    member = materialise(spread.join(full, "bucket").select("bucket", "leader", "members", "rep"), "minhash-buckets")
    info = reps.select("rep", "n", "sketch")
    pairs = member.where("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = pairs.join(info.toDF("a", "na", "sa"), "a").join(info.toDF("b", "nb", "sb"), "b")
    first = materialise(_close(pairs, percent).groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "minhash-first")
    involved = member.select(F.col("rep").alias("id")).distinct()
    squeezed = docs.mapInArrow(_squeeze, "id long, z binary").join(involved, "id").dropDuplicates(["id", "z"])  # an id may come with several texts
    texts = materialise(squeezed, "minhash-texts")

    def confirm(x: DataFrame, label: str) -> DataFrame:
        x = x.join(texts.toDF("a", "za"), "a").join(texts.toDF("b", "zb"), "b").select("a", "b", "za", "zb")
        return materialise(x.mapInArrow(_confirm(width, percent), "a long, b long").distinct(), label)

    links = confirm(first, "minhash-links").union(_versions(signs, reps))
    parts = connected_components(links, "minhash-1")
    # buckets that still hold several components: all pairs across them, in blocks
    placed = member.join(parts.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    open_ = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).where("lo < hi")
    rows = placed.join(open_.select("bucket", "blocks"), "bucket").join(info, "rep")
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    side = F.when(low == high, 0).when(F.col("mine") < F.col("other"), 1).otherwise(2)
    rows = rows.select(F.xxhash64("bucket", low, high).alias("cell"), side.cast("int").alias("side"), F.col("rep").alias("id"), "component", "n", "sketch")
    count = parts_for(docs, 8 << 20)
    across = rows.groupBy(F.pmod(F.col("cell"), F.lit(count)).alias("part")).applyInArrow(_across(percent), "a long, b long").distinct()
    across = materialise(across.join(first, ["a", "b"], "left_anti"), "minhash-across")
    more = confirm(across, "minhash-more")
    if more.limit(1).count():
        parts = connected_components(links.union(more), "minhash-2")
    return signs, reps, parts


def _versions(signs: DataFrame, reps: DataFrame) -> DataFrame:
    """Links between the representatives of the sets that one id has, where it comes with several texts."""
    several = signs.where("n > 0").groupBy("id").agg(*[(F.min(c) != F.max(c)).alias(f"_{c}") for c in ("n", "f1", "f2")]).where("_n or _f1 or _f2").select("id")
    found = signs.join(several, "id").select("id", "n", "f1", "f2").distinct().join(reps.select("n", "f1", "f2", "rep"), ["n", "f1", "f2"])
    least = found.groupBy("id").agg(F.min("rep").alias("a"))
    return found.join(least, "id").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()


SALTS = 16


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, block: int = 2000, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id, kept``."""
    named = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    signs, reps, parts = _links(named.where("id is not null"), width, percent, block)
    classes = reps.select("n", "f1", "f2", "rep").join(parts.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    salted = classes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    every = signs.select("id", "n", "f1", "f2", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
    found = every.join(salted, ["n", "f1", "f2", "salt"], "left").withColumn("component", F.coalesce("component", "id"))
    out = found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))
    nobody = named.where("id is null").select(F.col("id").alias("doc_id"), F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(nobody)


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of docs that stay: of each component the document of smallest id, once; rows without id stay.

    Of rows of that id with several texts, the one whose text sorts first stays.
    """
    kept = near_duplicates(docs, width, percent, id_column=id_column, text_column=text_column).where("kept and doc_id is not null").select(F.col("doc_id").alias("_kept_id")).distinct()
    key = F.col(f"`{id_column}`")
    rows = docs.join(kept, docs[f"`{id_column}`"].cast("long") == kept["_kept_id"], "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = rows.groupBy(key.cast("long")).agg(F.min_by(whole, F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))).alias("_row")).select("_row.*")
    return rows.unionByName(docs.where(key.isNull()))


#: DuckDB SQL of the query, with shingles of two words; ids are distinct.
NEAR_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM d),
docs AS (SELECT doc_id, coalesce(len(s), 0)::BIGINT AS n FROM sets),
flat AS (SELECT doc_id, unnest(s) AS x FROM sets),
rare AS (SELECT doc_id, flat.x, row_number() OVER (PARTITION BY doc_id ORDER BY c.k, flat.x) AS place FROM flat JOIN (SELECT x, count(*) AS k FROM flat GROUP BY x) c USING (x)),
-- two sets of similarity 0.8 share one of the rarest fifth, and one more, of either
heads AS (SELECT r.doc_id, r.x, docs.n FROM rare r JOIN docs USING (doc_id) WHERE r.place <= docs.n - ceil(0.8 * docs.n) + 1),
near AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM heads a JOIN heads b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n),
links AS (SELECT a, b FROM (SELECT near.a, near.b, len(list_intersect(x.s, y.s)) AS k, len(x.s) + len(y.s) AS t FROM near JOIN sets x ON x.doc_id = near.a JOIN sets y ON y.doc_id = near.b) WHERE 100 * k >= 80 * (t - k)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS id, doc_id AS c FROM docs UNION SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON reach.c = both_ways.a)
SELECT doc_id, n AS n_shingles, least AS component_id, doc_id = least AS kept FROM docs JOIN (SELECT id, min(c) AS least FROM reach GROUP BY id) ON id = doc_id
"""
