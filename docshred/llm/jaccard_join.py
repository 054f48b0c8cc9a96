"""n-gram Jaccard self-join by T-occurrence search.

A document is the set of its distinct shingles (``width`` words, lower case A-Z;
the whole sequence when it has fewer words; nothing without words).  Two
documents link when the Jaccard similarity of their sets is at least
``percent``/100.  Exact; no cap on lists, candidates or partners.

1. Equal sets become one class (128-bit digest), so copies are never compared.
2. Pruning.  A set that links with another misses at most n - ceil(p n) of its
   shingles there.  Over a fixed hash range of all shingles, a set whose
   shingles without a second owner already exceed that number has no partner.
   One sorted shuffle of that range finds these owners; a shingle that repeats
   within a task's slice is announced once, so a hot one stays small.  The
   classes that remain are pruned once more over the whole range.
3. The inverted lists of the remaining classes: shingles with a single owner
   carry no link and only count; the others are ordered by list length.
4. Partners share a shingle among the first n - ceil(p n) + 1 of that order
   (prefix filter).  Each prefix list first pairs its members with one pivot, and
   linked classes are merged.
5. T-occurrence search (DivideSkip) for the rest: classes are placed in blocks
   with the others of their longest prefix list, and every class asks each block
   that holds a class of another component on one of its prefix lists.  In a
   block the short inverted lists are merged with a heap, members that can still
   reach the overlap T are looked up in the L longest lists by binary search, and
   those with T occurrences or more are links.  No pairs are listed: rows are
   classes times blocks, and groups of near copies cost no more.
6. Components of the links; every row gets its class's smallest reachable id.

Null and empty texts have no shingles and are linked with nothing: their
component is their own id.  Rows that share an id but not a text are distinct
members of their classes; the smaller id decides.  A null id never names a
component (it is null where no id is reachable).
"""

from __future__ import annotations

import hashlib
import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docshred.llm.common import HIGH_BITS, bit_filter, discard, passing, slices, stored
from docshred.llm.components import components
from docshred.llm.words import mix, split_words, windows

MARK_SHARE = 0.3125  # part of the hash range that the first pruning step looks at
PROBE_COST = 0.0085  # cost of a probe step against a merge step, from the method's paper
BLOCK = 512  # classes that are searched together


def required(n: int | np.ndarray, m: int | np.ndarray, percent: int):
    """Least overlap of sets of n and m shingles at ``percent`` similarity."""
    return -(-percent * (n + m) // (100 + percent))


def needed(n, percent: int):
    """Least overlap that a set of n shingles has with any partner."""
    return -(-percent * n // 100)


def shingles(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    batch = split_words(texts)
    h, at = windows(batch, width)
    count = np.diff(batch.first)
    cut = np.searchsorted(at, batch.first)
    out = []
    for k in range(len(batch)):
        if count[k] >= width:
            out.append(np.unique(h[cut[k]:cut[k + 1]]))
        elif count[k]:
            whole = np.uint64(count[k])
            for x in batch.hash[batch.first[k]:batch.first[k + 1]]:
                whole = mix(np.array([whole ^ x], dtype=np.uint64))[0]
            out.append(np.array([whole], dtype=np.uint64))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def class_of(s: np.ndarray) -> str | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64), pa.int64())


def _members(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingles(batch.column(1).to_pylist(), width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([class_of(s) for s in sets], pa.string())], ["doc_id", "key", "n", "cls"])
    return work


def _marks(width: int, percent: int, share: float):
    """(token, key, kind, slack): one row per shingle of the range and document
    (texts, or the sets themselves when the second column is a list).

    A shingle with several owners in the slice is announced once (known 0, no
    owner asked for); its owners get one row each with the number of such
    shingles, under a spread-out token of their own.  Of a token the high bits are
    given: shingles equal in them count as shared, so the pruning errs on the safe
    side."""
    limit = np.uint64(int(share * 2**63) * 2 - 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches) if share < 1 else batches:
            sets = shingles(batch.column(1).to_pylist(), width) if share < 1 else _arrays(batch.column(1))
            key = np.array(batch.column(0).to_pylist(), dtype=np.int64)
            part = [s[:np.searchsorted(s, limit)] for s in sets]
            token = np.concatenate([np.empty(0, np.uint64), *part])
            owner = np.repeat(np.arange(len(sets)), [len(p) for p in part])
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            new = np.concatenate(([True], token[1:] != token[:-1])) if len(token) else np.empty(0, bool)
            start = np.flatnonzero(new)
            size = np.diff(np.concatenate((start, [len(token)])))
            many = np.repeat(size > 1, size)
            known = np.bincount(owner[many], minlength=len(sets))
            docs = np.array([k for k in range(len(sets)) if len(sets[k])], dtype=np.int64)
            size_of = np.array([len(s) for s in sets], dtype=np.int64)
            in_range = np.array([len(p) for p in part], dtype=np.int64)
            one, shared = start[size == 1], start[size > 1]
            figures = mix(key[docs].view(np.uint64))
            # kinds: 0 owner to be counted, 1 announcement, 2 the document's own figures
            yield pa.RecordBatch.from_arrays(
                [_signed(np.concatenate([token[one], token[shared], figures]) & HIGH_BITS),
                 pa.array(np.concatenate([key[owner[one]], np.zeros(len(shared), np.int64), key[docs]])),
                 pa.array(np.concatenate([np.zeros(len(one), np.int8), np.ones(len(shared), np.int8),
                                          np.full(len(docs), 2, np.int8)])),
                 # what the set can miss, less what is surely missing: kept docs end with a sum >= 0
                 pa.array(np.concatenate([np.zeros(len(one) + len(shared), np.int64),
                                          known[docs] - in_range[docs] + (size_of[docs] - needed(size_of[docs], percent))]))],
                ["token", "key", "kind", "slack"])
    return work


def _owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by token: one point for every owner of a token with
    another row (a row of kind 2 with an equal value is no owner, yet may add a
    point: the pruning errs on the safe side), and the documents' own figures.
    Streams; a run that a batch's end cuts goes on in the next batch."""
    held: tuple[int, int, int] | None = None  # (token, key or -1 when already given, kind)
    for batch in batches:
        token, key, kind, slack = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        if not len(token):
            continue
        same = token[1:] == token[:-1]
        before = np.concatenate(([held is not None and held[0] == token[0]], same))
        after = np.concatenate((same, [False]))
        point = (before | after) & (kind == 0)
        keys, values = [key[point], key[kind == 2]], [np.ones(int(point.sum()), np.int64), slack[kind == 2]]
        if before[0] and held[2] == 0:
            keys.append(np.array([held[1]]))
            values.append(np.ones(1, np.int64))
        tail_done = point[-1] or kind[-1] != 0
        held = (int(token[-1]), int(key[-1]), 1 if tail_done else 0)
        k, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate(values), minlength=len(k)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(total)], ["key", "slack"])


def _sets(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingles(batch.column(1).to_pylist(), width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([class_of(s) for s in sets], pa.string()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["key", "cls", "tokens"])
    return work


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    return [c.values.to_numpy(zero_copy_only=False).view(np.uint64) for c in column]


MARKS = "token bigint, key bigint, kind tinyint, slack bigint"


def possible(marks: DataFrame) -> DataFrame:
    """Keys whose sets may still have a partner."""
    points = marks.repartition("token").sortWithinPartitions("token").mapInArrow(_owners, "key bigint, slack bigint")
    return points.groupBy("key").agg(F.sum("slack").alias("slack")).where("slack >= 0").select("key")


def t_occurrence(lists: list[list[int]], target) -> list[int]:
    """Members that occur in at least ``target[member]`` of the sorted lists.

    DivideSkip: the L longest lists are set aside, the others are merged with a
    heap, and a member that can still reach its target is looked up in the long
    ones by binary search until it cannot."""
    if not lists:
        return []
    lists = sorted(lists, key=len)
    least = min(int(target[c]) for c in set().union(*lists))
    if len(lists) < least:
        return []
    spare = int(least / (PROBE_COST * np.log2(max(len(lists[-1]), 2)) + 1))
    keep = len(lists) - max(0, min(least - 1, spare))
    short, long = lists[:keep], lists[keep:]
    found: list[int] = []

    def settle(c: int, have: int) -> None:
        missing = have + len(long) - int(target[c])  # lists it may still be absent from
        for one in long:
            if missing < 0:
                return
            place = bisect_left(one, c)
            if place == len(one) or one[place] != c:
                missing -= 1
        if missing >= 0:
            found.append(c)

    at, count = -1, 0
    for c in heapq.merge(*short):
        if c != at:
            if at >= 0:
                settle(at, count)
            at, count = c, 0
        count += 1
    if at >= 0:
        settle(at, count)
    return found


class ListIndex:
    """Inverted lists of a block of sets (sorted token arrays)."""

    def __init__(self, members: list[np.ndarray]):
        token = np.concatenate([np.empty(0, np.int64), *members])
        owner = np.repeat(np.arange(len(members)), [len(m) for m in members])
        order = np.argsort(token, kind="stable")
        self.owner = owner[order]
        self.token, start = np.unique(token[order], return_index=True)
        self.bounds = np.append(start, len(token))

    def lists(self, query: np.ndarray, allowed: np.ndarray) -> list[list[int]]:
        """The lists of the query's tokens, without members that are not allowed."""
        if not len(self.token):
            return []
        k = np.minimum(np.searchsorted(self.token, query), len(self.token) - 1)
        k = k[self.token[k] == query]
        size = self.bounds[k + 1] - self.bounds[k]
        first = np.cumsum(size) - size
        owner = self.owner[np.arange(size.sum()) + np.repeat(self.bounds[k] - first, size)]
        fit = allowed[owner]
        which = np.repeat(np.arange(len(k)), size)[fit]
        cut = np.flatnonzero(np.diff(which)) + 1
        return [part.tolist() for part in np.split(owner[fit], cut) if len(part)]


def divide_skip(query: np.ndarray, candidates: list[np.ndarray], sizes: np.ndarray, query_size: int,
                percent: int) -> list[int]:
    """Candidates (indexes) whose overlap with the query reaches their T.

    ``query`` and ``candidates`` hold sorted tokens with more than one owner;
    sizes are those of the whole sets."""
    index = ListIndex(candidates)
    return t_occurrence(index.lists(query, np.ones(len(candidates), dtype=bool)), required(query_size, sizes, percent))


def _verify(percent: int):
    def work(key, table):
        names = table.column("cls").to_pylist()
        tokens = [c.values.to_numpy(zero_copy_only=False) for c in table.column("shared")]
        sizes = table.column("n").to_numpy()
        q = names.index(key[0].as_py())
        others = np.array([k for k in range(len(names)) if k != q], dtype=np.int64)
        hit = divide_skip(tokens[q], [tokens[k] for k in others], sizes[others], int(sizes[q]), percent)
        return pa.table({"a": pa.array([names[q]] * len(hit), pa.string()),
                         "b": pa.array([names[others[k]] for k in hit], pa.string())})
    return work


def search(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among candidate pairs (q, c): DivideSkip per query and block of
    candidates; the query's own row comes once to each of its blocks."""
    many = pairs.groupBy("q").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    placed = pairs.join(many, "q").select("q", F.pmod(F.xxhash64("c"), "blocks").alias("block"), F.col("c").alias("cls"))
    queries = many.select("q", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"),
                          F.col("q").alias("cls"))
    rows = placed.unionAll(queries).join(sets.select("cls", "n", "shared"), "cls")
    return rows.groupBy("q", "block").applyInArrow(_verify(percent), "a string, b string")


def row_key(id_col: str, text_col: str):
    """64-bit key of a row's id and text."""
    return F.xxhash64(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))


def similarity_components(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, group, key) for every row of ``docs``:
    ``group`` names the component (null without shingles), ``key`` the row's id and text."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("key", row_key("doc_id", "text"))
    members = stored(rows.mapInArrow(_members(width), "doc_id bigint, key bigint, n bigint, cls string"), "members")
    classes = members.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"), F.min("key").alias("key"))
    links = similar_classes(rows, classes.select("key"), width, percent)
    joined = components(links)
    discard(links)
    named = joined.join(classes, F.col("node") == F.col("cls"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    label = classes.join(joined, F.col("cls") == F.col("node"), "left").join(least, "root", "left").select(
        F.col("cls").alias("_cls"), F.coalesce("component_id", "least").alias("component_id"),
        F.coalesce("root", "cls").alias("group"))
    return members.join(label, F.col("cls") == F.col("_cls"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "group", "key")


def similar_classes(rows: DataFrame, one_each: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) that connect all classes of equal sets that are connected by
    similarity (not every link inside one component is listed).  ``rows`` have a
    key, ``one_each`` names one row of each class."""
    kept = possible(rows.select("key", "text").mapInArrow(_marks(width, percent, MARK_SHARE), MARKS))
    wanted = stored(kept.join(one_each, "key"), "wanted")
    # only texts that may be among the wanted ones are shuffled to their keys
    alive = rows.select("key", "text").mapInArrow(
        passing(bit_filter(wanted.select(F.col("key").alias("h"))), 0), "key bigint, text string")
    alive = alive.join(wanted, "key", "left_semi").dropDuplicates(["key"])
    sets = stored(alive.mapInArrow(_sets(width), "key bigint, cls string, tokens array<bigint>"), "sets")
    discard(wanted)
    again = possible(sets.select("key", "tokens").mapInArrow(_marks(width, percent, 1.0), MARKS))
    alive = sets
    sets = stored(alive.join(again, "key", "left_semi"), "sets")
    discard(alive)
    owned = sets.select("cls", F.size("tokens").cast("bigint").alias("n"), F.explode("tokens").alias("token"))
    lists = owned.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    shared = owned.join(lists, "token").groupBy("cls", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "token"))).alias("by_df"))
    own = F.col("n") - F.size("by_df")
    prefix = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1
    active = stored(shared.where(own < prefix).select(
        "cls", "n", own.alias("own"), F.array_sort("by_df.token").alias("shared"),
        F.slice(F.col("by_df.token"), 1, (prefix - own).cast("int")).alias("prefix")), "active")
    discard(sets)
    lists = active.select("cls", "n", "own", F.posexplode("prefix").alias("i", "token")).select(
        "token", "cls", "n", (F.col("n") - F.col("own") - F.col("i")).alias("rest"))
    pivot = lists.groupBy("token").agg(F.min(F.struct("n", "cls", "rest")).alias("p"), F.count("*").alias("df")).where("df > 1")
    star = lists.join(pivot, "token").where(F.col("cls") != F.col("p.cls")).where(
        _can_link(F.col("n"), F.col("rest"), F.col("p.n"), F.col("p.rest"), percent))
    star = star.select(F.col("p.cls").alias("q"), F.col("cls").alias("c")).distinct()
    first = stored(search(star, active, percent), "star")
    merged = components(first)
    rooted = active.join(merged, F.col("cls") == F.col("node"), "left").select(
        "cls", "n", "shared", F.coalesce("root", "cls").alias("root"))
    placed = lists.select("token", "cls").join(rooted.select("cls", "root"), "cls")
    mixed = placed.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("df")).where(
        "lo <> hi").select("token", "df")
    placed = placed.join(mixed, "token")
    # a class lives with the others of its longest list, so that a group's
    # members share blocks; long lists are dealt over several blocks
    home = placed.groupBy("cls", "root").agg(F.max(F.struct("df", "token")).alias("h")).select(
        "cls", "root", F.struct(F.col("h.token").alias("t"), F.pmod(
            F.xxhash64("cls"), F.ceil(F.col("h.df") / BLOCK)).alias("k")).alias("block"))
    home = stored(home, "home")
    reach = placed.join(home.select("cls", "block"), "cls").groupBy("token", "block").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"))
    asked = placed.select("token", F.col("cls"), F.col("root")).join(reach, "token").where(
        (F.col("lo") != F.col("root")) | (F.col("hi") != F.col("root"))).select("cls", "block").distinct()
    links = stored(first.unionAll(block_search(asked, home.select("cls", "block"), rooted, percent)), "links")
    discard(active, first, home)
    return links


def block_search(asked: DataFrame, home: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of the query classes to members of the blocks they ask (cls, block):
    as many as it takes to join what a block's task finds connected, so fewer
    links than classes in each task.

    A block and a share of its queries make one group of bounded size, however
    many queries ask a block."""
    asked = asked.withColumn("block", F.xxhash64("block"))
    home = home.withColumn("block", F.xxhash64("block"))
    shares = asked.groupBy("block").agg(F.ceil(F.count("*") / (2 * BLOCK)).alias("shares"))
    queries = asked.join(shares, "block").select("cls", "block", F.pmod(F.xxhash64("cls"), "shares").alias("share"),
                                                 F.lit(True).alias("query"))
    members = home.join(shares, "block").select("cls", "block", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("shares") - 1)).alias("share"), F.lit(False).alias("query"))
    rows = queries.unionAll(members).join(sets, "cls")
    return rows.groupBy("block", "share").applyInArrow(_search_block(percent), "a string, b string")


def _search_block(percent: int):
    def work(key, table):
        rows = table.combine_chunks()
        name, root = rows.column("cls").to_pylist(), rows.column("root").to_pylist()
        is_query = np.array(rows.column("query").to_pylist(), dtype=bool)
        n = rows.column("n").to_numpy()
        tokens = [v.values.to_numpy(zero_copy_only=False) for v in rows.column("shared")]
        rank = {c: k for k, c in enumerate(sorted(set(name)))}
        number = np.array([rank[c] for c in name])
        group = np.unique(np.array(root, dtype=object).astype(str), return_inverse=True)[1]
        held = np.array([len(t) for t in tokens])
        member = np.flatnonzero(~is_query)
        index = ListIndex([tokens[k] for k in member])
        a, b = [], []
        for q in np.flatnonzero(is_query).tolist():
            target = required(int(n[q]), n[member], percent)
            allowed = ((number[member] < number[q]) & (group[member] != group[q])
                       & (np.minimum(held[member], held[q]) >= target))
            if not allowed.any():
                continue
            for c in t_occurrence(index.lists(tokens[q], allowed), target):
                if group[member[c]] != group[q]:
                    a.append(name[q])
                    b.append(name[member[c]])
                    group[group == group[member[c]]] = group[q]  # joined from here on
        return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string())})
    return work


def _can_link(n, rest, m, rest_m, percent: int):
    """Length bound and position bound: from a list's place on, two sets share
    at most the tokens that both still have there."""
    most = F.least(rest, rest_m)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * most >= percent * (n + m))
