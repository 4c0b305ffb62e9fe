"""Near-duplicate documents by bottom-k sketches.

One hash function maps the distinct word shingles of a text to 64 bits. The k
smallest values are its sketch; a text with at most ``whole`` shingles keeps
them all. Steps:

1. Texts with the same shingle set are one node (its smallest doc_id).
2. Inverted lists of retained values give overlaps. Each value has a document
   frequency; a node enters the lists of its rarest values only, as many as a
   partner that shares the required overlap cannot avoid, so boilerplate lists
   stay empty. For whole sketches this filter is exact. For cut ones the
   required overlap is ``overlap`` of ``k``: a pair at the threshold shares less
   with a probability below 4e-9 (Chernoff bound: 80 of 128 at 0.85, 71 at 0.8).
3. In each list a leader (the node with the fewest values of its own) is paired
   with the members: linear in the list. Pairs are filtered by the estimate
   from the union sketch and confirmed on the full shingle sets.
4. Lists that then still hold two components are settled on full sets: prefix
   lists again, with a positional bound, only between components. No pair that
   could be a link and joins two components is left out.
5. Connected components by alternating star contractions.

Groups of copies and near copies thus cost links in proportion to their size.
Lists, labels and links stay distributed; joins on hot values are split by
Spark. Id lists are broadcast below a counted bound and joined by a shuffle
above it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from evidentia.llm.common import discard, stored

#: Ids are broadcast up to this number of rows (16 MB of longs).
BROADCAST_IDS = 2_000_000
#: Documents in a batch of results.
_ROWS = 200


@dataclass(frozen=True)
class Links:
    words: int = 5
    percent: int = 85
    k: int = 128
    whole: int = 192

    @property
    def overlap(self) -> int:
        """Most common values of two cut sketches that a pair at the threshold misses with a probability below 4e-9.

        Chernoff: fewer than o of k common with a probability of at most
        exp(-k * KL(o / k, percent / 100)).
        """
        p = self.percent / 100
        if p >= 1:
            return self.k

        def miss(o: int) -> float:
            q = o / self.k
            kl = (q * math.log(q / p) if q else 0.0) + (1 - q) * math.log((1 - q) / (1 - p))
            return math.exp(-self.k * kl)

        return max((o for o in range(self.k) if o < self.k * p and miss(o) < 4e-9), default=0)

    @property
    def exact(self) -> int:
        """Largest set whose partners all keep whole sketches."""
        return self.whole * self.percent // 100


def shingles(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text, A-Z in lower case.

    bytes.split() separates at [\\x20\\x09-\\x0D] and bytes.lower() changes A-Z only.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.int64)
    runs = [words] if len(words) < size else zip(*[words[i:] for i in range(size)])
    found = set(map(xxhash.xxh64_intdigest, map(b" ".join, runs)))
    out = np.fromiter(found, np.uint64, len(found)).view(np.int64)
    out.sort()
    return out


def _arrays(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(r) for r in rows])].astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(rows) if rows else np.empty(0, np.int64)))


def _sets(docs: DataFrame, how: Links, full: bool) -> DataFrame:
    """(doc_id, n, digest, values): the sketch, or with ``full`` the whole set, of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].cast(pa.binary())
            for at in range(0, batch.num_rows, _ROWS):
                part = texts.slice(at, _ROWS).to_pylist()
                sets = [shingles(t or b"", how.words) for t in part]
                kept = [s if full or len(s) <= how.whole else s[: how.k] for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(at, _ROWS),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()),
                        _arrays(kept),
                    ],
                    ["doc_id", "n", "digest", "values"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, digest binary, values array<long>")


def _among(df: DataFrame, ids: DataFrame, on: list[str], how: str) -> DataFrame:
    """Semi or anti join with a list of ids, which is broadcast below the bound."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, on, how)


def _possible(how: Links, a: str, b: str) -> Column:
    """Whether two nodes of sizes n with u values of their own can reach the threshold."""
    n1, n2, u1, u2 = (F.col(x) for x in (f"{a}n", f"{b}n", f"{a}u", f"{b}u"))
    both = (n1 <= how.whole) & (n2 <= how.whole)
    most = F.when(both, F.least(n1 - u1, n2 - u2)).otherwise(F.least(n1, n2))
    enough = both | (F.least(_retained(how, n1) - u1, _retained(how, n2) - u2) >= how.overlap)
    return (100 * most >= how.percent * (n1 + n2 - most)) & enough


def _retained(how: Links, n: Column) -> Column:
    return F.when(n <= how.whole, n).otherwise(F.lit(how.k))


def inverted_lists(sketches: DataFrame, how: Links) -> DataFrame:
    """(v, doc_id, n, u): the lists that hold two nodes or more, rare values first."""
    postings = sketches.select("doc_id", "n", F.explode("values").alias("v"))
    frequent = postings.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    shared = postings.join(frequent, "v")
    nodes = shared.groupBy("doc_id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("s"))  # at most `whole` each
    need = F.when(F.col("n") <= how.exact, F.ceil(how.percent * F.col("n") / 100)).otherwise(F.lit(how.overlap))
    nodes = nodes.withColumn("u", _retained(how, F.col("n")) - F.size("s"))
    prefix = (_retained(how, F.col("n")) - need + 1 - F.col("u")).cast("int")
    nodes = nodes.withColumn("prefix", prefix).where("prefix > 0")
    lists = nodes.select("doc_id", "n", "u", F.explode(F.slice("s", F.lit(1), F.col("prefix"))).alias("x"))
    return lists.select(F.col("x.v").alias("v"), "doc_id", "n", "u")


def across_components(nodes: DataFrame, how: Links) -> DataFrame:
    """Pairs (a, b) of different components that may be links, for (doc_id, values, component) with full sets.

    Prefix lists on full sets, rare values first, with the position of the
    value in each set: a pair need only be met at the first value it shares, and
    there at most the values from that position on are common. A member apart
    from its list's main component differs from the core in more than the
    threshold allows, so it falls to this bound in the long lists.
    """
    sized = nodes.withColumn("n", F.size("values"))
    postings = sized.select("doc_id", F.explode("values").alias("v"))
    frequent = postings.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    orders = postings.join(frequent, "v").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("s"))
    orders = orders.join(sized.select("doc_id", "n", "component"), "doc_id").withColumn("own", F.col("n") - F.size("s"))
    least = F.ceil(how.percent * F.col("n") / 100)
    orders = orders.withColumn("prefix", (F.col("n") - least + 1 - F.col("own")).cast("int")).where("prefix > 0")
    lists = orders.select("doc_id", "n", "component", "own", F.posexplode(F.slice("s", F.lit(1), F.col("prefix"))).alias("i", "x"))
    lists = lists.select(F.col("x.v").alias("v"), "doc_id", "n", "component", (F.col("own") + F.col("i")).alias("before"))
    lists = stored(lists)
    heads = lists.groupBy("v").agg(
        F.min(F.struct("before", "doc_id", "component")).alias("h"), F.min("n").alias("shortest"),
        F.min("component").alias("low"), F.max("component").alias("high"),
    ).where("low <> high").select("v", F.col("h.component").alias("main"), "shortest")
    lists = lists.join(heads, "v")
    needed = lambda n1, n2: how.percent * (n1 + n2)
    left = (100 + how.percent) * (F.col("n") - F.col("before"))
    apart = lists.where((F.col("component") != F.col("main")) & (left >= needed(F.col("n"), F.greatest("shortest", least))))
    apart = apart.select("v", *[F.col(c).alias(f"r_{c}") for c in ("doc_id", "n", "component", "before")])
    r_left = (100 + how.percent) * (F.col("r_n") - F.col("r_before"))
    met = apart.join(lists, "v").where(
        (F.col("r_component") != F.col("component"))
        & ((F.col("component") == F.col("main")) | (F.col("r_doc_id") < F.col("doc_id")))
        & (100 * F.least("n", "r_n") >= how.percent * F.greatest("n", "r_n"))
        & (F.least(left, r_left) >= needed(F.col("n"), F.col("r_n")))
    )
    return met.select(F.least("r_doc_id", "doc_id").alias("a"), F.greatest("r_doc_id", "doc_id").alias("b")).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, how: Links) -> DataFrame:
    """The pairs (a, b) that reach the threshold: union-sketch estimate first, then the full sets."""
    one = lambda x: sets.select(F.col("doc_id").alias(x), F.col("values").alias(f"{x}_set"))
    rows = pairs.join(one("a"), "a").join(one("b"), "b")
    whole = (F.size("a_set") <= how.whole) & (F.size("b_set") <= how.whole)
    first = lambda x: F.when(F.size(x) <= how.whole, F.col(x)).otherwise(F.slice(x, 1, how.k))
    smallest = F.slice(F.array_sort(F.array_union(first("a_set"), first("b_set"))), 1, how.k)
    estimate = F.size(F.array_intersect(smallest, F.array_intersect(first("a_set"), first("b_set"))))
    rows = rows.where(whole | (estimate >= how.overlap))
    common = F.size(F.array_intersect("a_set", "b_set"))
    return rows.where(100 * common >= how.percent * (F.size("a_set") + F.size("b_set") - common)).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over (a, b), by large-star and small-star rounds."""

    def stars(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        )
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = both.join(least, "a")
        out = joined.where("b > a" if large else "b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            out = out.union(least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    edges = stored(edges.where("a <> b").distinct())
    before = None
    while (now := state(edges)) != before:
        old, before = edges, now
        edges = stored(stars(stars(edges, True), False))
        discard(old)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def near_duplicates(docs: DataFrame, how: Links = Links()) -> DataFrame:
    """One row for each row of (doc_id, text): doc_id, n_shingles, component_id, kept.

    Null, empty and blank texts have no shingles and link with nothing. Fewer
    words than a shingle: the whole sequence is one shingle. Rows without
    doc_id are kept and have no component. A repeated row is one document; if
    an id repeats with different texts, the text with the smallest digest
    stands for the id. Ties cannot arise: the smallest id represents a group.
    An empty table gives an empty result; further columns are not read.
    """
    rows = stored(_sets(docs, how, False))
    narrow = rows.select("doc_id", "n", "digest")
    usable = narrow.where("n > 0 and doc_id is not null")
    nodes = usable.groupBy("doc_id").agg(F.min("digest").alias("digest"), F.count("*").alias("times"))
    nodes = stored(nodes.join(nodes.groupBy("digest").agg(F.min("doc_id").alias("node")), "digest"))
    copies = usable.join(nodes.where("doc_id = node"), ["doc_id", "digest"], "left_anti").select("doc_id", "digest")
    sketches = _among(rows.where("n > 0 and doc_id is not null"), copies.distinct(), ["doc_id", "digest"], "left_anti")
    if nodes.where("times > 1").limit(1).count():
        sketches = sketches.dropDuplicates(["doc_id"])
    lists = stored(inverted_lists(sketches, how))

    sized = lists.groupBy("v").agg(
        F.min(F.struct("u", "doc_id", "n")).alias("l"), F.count("*").alias("members")
    ).where("members > 1").select("v", F.col("l.doc_id").alias("leader"), F.col("l.n").alias("ln"), F.col("l.u").alias("lu"))
    active = lists.join(sized.select("v"), "v", "left_semi").select("doc_id").distinct()
    texts = _among(docs.select(F.col("doc_id").cast("long"), "text"), stored(active), ["doc_id"], "left_semi")
    sets = _sets(texts, how, True)
    sets = stored(sets.join(nodes.select("doc_id", "digest"), ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id"]).select("doc_id", "values"))

    pair = (F.least("leader", "doc_id").alias("a"), F.greatest("leader", "doc_id").alias("b"))
    tried = lists.join(sized, "v").where("leader <> doc_id").where(_possible(how, "l", ""))
    tried = stored(tried.select(*pair).distinct())
    links = stored(confirmed(tried, sets, how))
    found = components(links)

    named = found.withColumnRenamed("node", "doc_id")
    labelled = lists.join(named, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    split = labelled.groupBy("v").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    open_nodes = stored(labelled.join(split.select("v"), "v", "left_semi").select("doc_id", "component").distinct())
    across = across_components(sets.join(open_nodes, "doc_id"), how).join(tried, ["a", "b"], "left_anti")
    more = stored(confirmed(across, sets, how))
    if more.limit(1).count():
        found = components(links.union(more))

    groups = nodes.select("doc_id", "node").join(found, "node", "left")
    groups = groups.select("doc_id", F.coalesce("component", "node").alias("component_id"))
    out = narrow.select("doc_id", F.col("n").alias("n_shingles")).join(groups, "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, how: Links = Links()) -> DataFrame:
    """Rows of ``docs`` whose document is kept (also rows without an id)."""
    gone = near_duplicates(docs, how).where(~F.col("kept")).select("doc_id").distinct()
    return _among(docs, stored(gone), ["doc_id"], "left_anti")


#: The contract's rows in DuckDB.
SQL = r"""
with recursive t as materialized (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as materialized (select distinct doc_id, h from (select doc_id, unnest(case when len(w) < 5 then [array_to_string(w, ' ')]
  else [array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)] end) as h from t where len(w) > 0)),
n as materialized (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.h = b.h and a.doc_id < b.doc_id group by all),
l as materialized (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
e as materialized (select a, b from l union all select b, a from l),
r as (select doc_id as node, doc_id as reach from documents union select r.node, e.b from r join e on r.reach = e.a),
m as (select node as doc_id, min(reach) as component_id from r group by node)
select t.doc_id, coalesce(n.n, 0) as n_shingles, component_id, t.doc_id = component_id as kept from t left join n using (doc_id) join m using (doc_id)
"""
