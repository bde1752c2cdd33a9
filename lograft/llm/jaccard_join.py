r"""N-gram Jaccard join with prefix trees.

A document's set holds the hashes of its distinct word n-grams in one global
order: those of one text only first, then by the number of holders.

1. Two sets of the wanted similarity share an element of their prefixes, the
   first n - ceil(t * n) + 1 elements.  ``groups.counts`` counts the holders of
   every element; an element of one text alone can never be the shared one, so
   few prefixes keep any element to meet under.
2. Sets meet where they are stored: a *visitor* travels to the groups of
   documents that share a key with it.  A count sketch of the set, an exact upper
   bound of any overlap, decides whether the set itself must travel.
3. There the ordered sets of the candidates stand in a prefix tree.  A visitor
   walks down the paths of its candidates; the overlap counted up to a node is
   shared by all sets below it, and a subtree is left when what remains on either
   side can no longer reach the needed overlap.

Two rounds find every connection without listing the pairs of a group.  First
only the centre of each key visits, which joins most members of a group of near
copies into one component.  Then the members outside a key's largest component
visit those with another label; members of one component need no comparison.

Equal texts are one row throughout; equal sets link like any others.

Defined results: texts without words, null or empty, are linked with nothing,
equal ones included; fewer words than an n-gram are one element; a row without a
doc_id has no number of its own and takes the smallest doc_id it can reach, else
null; rows that share a doc_id are judged each on its own text; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from . import rolling as R
from .components import components
from .groups import Counts, Layout, counts, lay_out, public_id, row_id, text_key, with_groups

WORDS, PERCENT = 4, 85
CELLS = 64  # cells of a count sketch


def shingle_sets(column, words: int):
    """(first row, element hashes, set bounds) per chunk; each set ascending and distinct."""
    for row, buf, offsets in R.chunks(column):
        buf = R.LOWER[buf]
        starts, ends, bounds = R.word_bounds(buf, offsets)
        sums = R.gram_sums(R.byte_hash(R.byte_sums(buf), starts, ends))
        at, doc = R.windows(bounds, words)
        counts = np.diff(bounds)
        short = np.flatnonzero((counts > 0) & (counts < words))
        hashes = np.concatenate((R.gram_hash(sums, at, at + words), R.gram_hash(sums, bounds[short], bounds[short + 1])))
        doc = np.concatenate((doc, short))
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        hashes, doc = hashes[new], doc[new]
        yield row, hashes, np.searchsorted(doc, np.arange(len(counts) + 1))


def in_order(hashes: np.ndarray, bounds: np.ndarray, held: Counts) -> tuple[np.ndarray, np.ndarray]:
    """Each set in the global order, as numbers that sort in it, and which elements other texts hold."""
    count = held.of(hashes)
    ranked = (count.astype(np.uint64) << np.uint64(56)) | (hashes >> np.uint64(8))
    order = np.lexsort((ranked, np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))))
    return ranked[order], count[order] > 0


def prefix_elements(bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Mask of the elements in the sets' prefixes, and the set of every element."""
    n = np.diff(bounds)
    owner = np.repeat(np.arange(len(n)), n)
    prefix = n + (-n * percent // 100) + 1  # n - ceil(t n) + 1
    return np.arange(len(owner)) - bounds[:-1][owner] < prefix[owner], owner


def sketches(elements: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    cell = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) * CELLS + (elements % np.uint64(CELLS)).astype(np.int64)
    return np.minimum(np.bincount(cell, minlength=(len(bounds) - 1) * CELLS), 65535).reshape(-1, CELLS).astype(np.uint16)


def linked(overlap, a, b, percent: int):
    """100 * intersection >= percent * union."""
    return 100 * overlap >= percent * (a + b - overlap)


class PrefixTree:
    """Ordered sets in a compressed trie; nodes hold (elements, smallest set below, largest set below, depth)."""

    def __init__(self, sets: list[np.ndarray]):
        self.nodes: list[tuple[np.ndarray, int, int, int]] = []
        self.paths: list[list[int]] = [[] for _ in sets]
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self._grow(sets, order, 0, [])

    def _grow(self, sets, members, depth, path):
        """Iterative: a subtree is a run of the sorted sets that share ``depth`` elements."""
        stack = [(members, depth, path)]
        while stack:
            members, depth, path = stack.pop()
            i = 0
            while i < len(members):
                first = sets[members[i]]
                if len(first) <= depth:  # ends at the parent
                    self.paths[members[i]] = path
                    i += 1
                    continue
                j = i + 1
                while j < len(members) and sets[members[j]][depth] == first[depth]:
                    j += 1
                own = members[i:j]
                last = sets[own[-1]]  # sorted: what the ends share, all share
                n = min(len(first), len(last))
                differ = np.flatnonzero(first[depth:n] != last[depth:n])
                end = depth + int(differ[0]) if len(differ) else n
                sizes = [len(sets[m]) for m in own]
                self.nodes.append((first[depth:end], min(sizes), max(sizes), end))
                stack.append((own, end, [*path, len(self.nodes) - 1]))
                i = j

    def probe(self, probe: np.ndarray, wanted, percent: int, step: int = 128):
        """The members of ``wanted`` (an iterable that may adapt to what was found) linked with ``probe``."""
        n = len(probe)
        known: dict[int, tuple[int, int] | None] = {}
        for member in wanted:
            overlap = at = 0
            for node in self.paths[member]:
                if node not in known:
                    edge, low, high, depth = self.nodes[node]
                    low = max(low, -(-n * percent // 100))
                    state: tuple[int, int] | None = (overlap, at)
                    for a in range(0, len(edge), step):
                        part = edge[a:a + step]
                        place = np.searchsorted(probe, part)
                        overlap += int((probe[np.minimum(place, n - 1)] == part).sum())
                        at = int(np.searchsorted(probe, part[-1], side="right"))
                        left = min(n - at, high - (depth - len(edge) + a + len(part)))
                        state = (overlap, at)
                        if not linked(overlap + left, n, low, percent):
                            state = None
                            break
                    known[node] = state
                if known[node] is None:
                    break
                overlap, at = known[node]
            else:
                path = self.paths[member]
                if path and linked(overlap, n, self.nodes[path[-1]][3], percent):
                    yield member


def _stored(df: DataFrame, name: str) -> DataFrame:
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def profiles(layout: Layout, words: int, percent: int) -> DataFrame:
    """Per text: g, h, id, n (set size) and, if its prefix holds an element of another text,
    these elements (keys), the ordered set and its sketch."""

    def keys_of(column):
        for _, hashes, bounds in shingle_sets(column, words):
            yield hashes, np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))

    schema = pa.schema([("g", pa.int32()), ("h", pa.binary()), ("id", pa.int64()), ("n", pa.int64()),
                        ("sketch", pa.binary()), ("keys", pa.list_(pa.int64())), ("elements", pa.binary())])
    n_buckets = 4 * layout.width

    def profile(texts: pa.Table, lists: pa.Table) -> pa.Table:
        held = Counts(lists, n_buckets)
        sizes, sketch, keys, sets = [], [], [], []
        for _, hashes, bounds in shingle_sets(texts["text"], words) if texts.num_rows else ():
            elements, shared = in_order(hashes, bounds, held)
            inside, owner = prefix_elements(bounds, percent)
            pick = np.flatnonzero(inside & shared)
            edge = np.searchsorted(owner[pick], np.arange(len(bounds)))
            cells = sketches(elements, bounds)
            for i in range(len(bounds) - 1):
                sizes.append(int(bounds[i + 1] - bounds[i]))
                keys.append(elements[pick[edge[i]:edge[i + 1]]].astype(np.int64))
                sketch.append(cells[i].tobytes() if len(keys[-1]) else None)
                sets.append(elements[bounds[i]:bounds[i + 1]].tobytes() if len(keys[-1]) else None)
        return pa.Table.from_arrays([texts["g"], texts["h"], texts["id"], pa.array(sizes, pa.int64()),
                                     pa.array(sketch, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                                     pa.array(sets, pa.binary())], schema=schema)

    return _stored(with_groups(layout, counts(layout, keys_of), profile, "g int, h binary, id bigint, n bigint, "
                               "sketch binary, keys array<bigint>, elements binary"), "profiles")


_VISITOR = ("h", "n", "sketch", "label", "members", "keys")


def _send(visitors: pa.Table) -> pa.Table:
    """The visitors of one home group, one row per group that they go to."""
    home, out = visitors["g"][0].as_py(), {"g": [], "home": []}
    targets = visitors["targets"].combine_chunks()
    goes, who = np.asarray(targets.flatten()), np.repeat(np.arange(visitors.num_rows), np.asarray(targets.value_lengths()))
    columns = {c: [] for c in _VISITOR}
    for g in np.unique(goes):
        rows = visitors.take(pa.array(who[goes == g]))
        out["g"].append(int(g))
        out["home"].append(home)
        for c in _VISITOR:
            columns[c].append(rows[c].to_pylist())
    kinds = {"h": pa.binary(), "n": pa.int64(), "sketch": pa.binary(), "label": pa.binary(), "members": pa.int64(),
             "keys": pa.list_(pa.int64())}
    return pa.table({"g": pa.array(out["g"], pa.int32()), "home": pa.array(out["home"], pa.int32())}
                    | {c: pa.array(columns[c], pa.list_(kinds[c])) for c in _VISITOR})


_SEND_SQL = ("g int, home int, h array<binary>, n array<bigint>, sketch array<binary>, label array<binary>, "
             "members array<bigint>, keys array<array<bigint>>")


def _candidates(percent: int, ranked: bool):
    """Visitors (right) against the profiles of a group (left): which sets can reach the similarity."""
    schema = pa.schema([("g", pa.int32()), ("c", pa.binary()), ("xs", pa.list_(pa.binary()))])

    def find(own: pa.Table, visitors: pa.Table) -> pa.Table:
        out = {f.name: [] for f in schema}
        if own.num_rows and visitors.num_rows:
            h, label = own["h"].to_pylist(), own["label"].to_pylist()
            place = list(zip(own["members"].to_pylist(), label))
            n = np.asarray(own["n"])
            sketch = np.frombuffer(b"".join(own["sketch"].to_pylist()), dtype=np.uint16).reshape(-1, CELLS)
            keys = own["keys"].combine_chunks()
            values, owner = np.asarray(keys.flatten()), np.repeat(np.arange(len(h)), np.asarray(keys.value_lengths()))
            at = np.argsort(values, kind="stable")
            values, owner = values[at], owner[at]
            g = own["g"][0].as_py()
            for visit in (v for row in visitors.to_pylist() for v in zip(*(row[c] for c in _VISITOR))):
                c, size, counts_, mine, members, wanted = visit
                wanted = np.array(wanted, dtype=np.int64)
                low, high = np.searchsorted(values, wanted), np.searchsorted(values, wanted, side="right")
                near = np.unique(np.concatenate([owner[a:z] for a, z in zip(low, high)]))
                near = near[linked(np.minimum(n[near], size), n[near], size, percent)]
                if not len(near):
                    continue
                cells = np.frombuffer(counts_, dtype=np.uint16)
                if not (cells == 65535).any():  # a full cell bounds nothing
                    most = np.minimum(sketch[near], cells).astype(np.int64).sum(axis=1)
                    near = near[linked(most, n[near], size, percent)]
                xs = [h[i] for i in near if label[i] != mine and (not ranked or (members, mine) < place[i])]
                if xs:
                    out["g"].append(g)
                    out["c"].append(c)
                    out["xs"].append(xs)
        return pa.table([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return find


def _visit(percent: int):
    """Visiting sets (right) against the prefix tree of a group's candidates (left): links that join two parts."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def visit(own: pa.Table, visitors: pa.Table) -> pa.Table:
        a, b = [], []
        if own.num_rows and visitors.num_rows:
            wanted = {x for xs in visitors["xs"].to_pylist() for x in xs}
            own = own.filter(pa.array([h in wanted for h in own["h"].to_pylist()]))
            names = own["h"].to_pylist()
            number = {h: i for i, h in enumerate(names)}
            tree = PrefixTree([np.frombuffer(x, dtype=np.uint64) for x in own["elements"].to_pylist()])
            parent: dict[bytes, bytes] = {}

            def root(x):
                while parent.get(x, x) != x:
                    parent[x] = parent.get(parent[x], parent[x])
                    x = parent[x]
                return x

            for c, xs, blob in zip(visitors["c"].to_pylist(), visitors["xs"].to_pylist(), visitors["elements"].to_pylist()):
                # a member already joined to the visitor through an earlier one needs no comparison
                open_ = (number[x] for x in xs if root(x) != root(c))
                for i in tree.probe(np.frombuffer(blob, dtype=np.uint64), open_, percent):
                    parent[root(names[i])] = root(c)
                    a.append(c)
                    b.append(names[i])
        return pa.table([pa.array(a, pa.binary()), pa.array(b, pa.binary())], schema=schema)

    return visit


def _round(meta: DataFrame, sets: DataFrame, percent: int, ranked: bool) -> DataFrame:
    """Links (a, b) found by one round of visits.

    ``meta`` has g, h, n, sketch, keys, label and members (texts under that label), ``sets`` the ordered sets.
    Unranked: the centre of each key visits.  Ranked: all members outside the key's largest label.
    """
    rank = F.struct("members", "label")
    t = meta.select("h", "g", "label", "members", F.explode("keys").alias("key"))
    # one row per key; the groups that hold it are at most the layout's width
    keys = (t.groupBy("key").agg(F.max(rank).alias("top"), F.min(rank).alias("low"), F.min("h").alias("centre"),
                                 F.collect_set("g").alias("targets"))
            .where(F.col("top") != F.col("low")).select("key", "top", "centre", "targets"))
    goes = (F.struct("members", "label") != F.col("top")) if ranked else (F.col("h") == F.col("centre"))
    visitors = (t.join(keys, "key").where(goes).groupBy("h")
                .agg(F.collect_set("key").alias("keys"),
                     F.array_distinct(F.flatten(F.collect_set("targets"))).alias("targets"))
                .join(meta.select("h", "g", "n", "sketch", "label", "members"), "h"))
    sent = visitors.select("g", "targets", *_VISITOR).groupBy("g").applyInArrow(_send, _SEND_SQL)
    found = (meta.select("g", *_VISITOR).groupBy("g").cogroup(sent.groupBy("g"))
             .applyInArrow(_candidates(percent, ranked), "g int, c binary, xs array<binary>"))
    found = _stored(found, "candidates")
    visits = (found.join(sets.select(F.col("h").alias("c"), F.col("elements").alias("set")), "c")
              .select("g", "c", "xs", F.col("set").alias("elements")))
    return sets.groupBy("g").cogroup(visits.groupBy("g")).applyInArrow(_visit(percent), "a binary, b binary")


def _label(texts: DataFrame, links: DataFrame) -> DataFrame:
    """``texts`` with label and members; a text without a link is its own component."""
    labels = components(links)
    sizes = labels.groupBy("label").agg(F.count("*").alias("members"))
    known = labels.join(sizes, "label").select(F.col("node").alias("h"), "label", "members")
    return (texts.join(known, "h", "left").withColumn("label", F.coalesce("label", "h"))
            .withColumn("members", F.coalesce("members", F.lit(1).cast("long"))))


def text_components(layout: Layout, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per distinct text: h (text key), id (its smallest), n (set size), label (of its component)."""
    profile = profiles(layout, words, percent)
    held = profile.where(F.size("keys") > 0)
    meta, sets = held.select("g", "h", "n", "sketch", "keys"), held.select("g", "h", "elements")
    alone = meta.withColumn("label", F.col("h")).withColumn("members", F.lit(1).cast("long"))
    first = _stored(_round(alone, sets, percent, False), "links")
    joined = _stored(_label(meta, first), "labelled")
    second = _round(joined, sets, percent, True)
    return _label(profile.select("h", "id", "n"), first.unionByName(second)).select("h", "id", "n", "label")


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: id, h (text key), n_shingles, label (of its component), component (smallest id)."""
    layout = lay_out(docs)
    final = text_components(layout, words, percent)
    smallest = final.groupBy("label").agg(F.min("id").alias("component"))
    texts = final.join(smallest, "label").select("h", "n", "label", "component")
    return (layout.rows.join(texts, "h").select(
        "id", "h", F.col("n").alias("n_shingles"), "label",
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component")))


def jaccard_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id per row of ``docs``."""
    return jaccard_components(docs, words, percent).select(
        public_id(F.col("id")).alias("doc_id"), "n_shingles", public_id(F.col("component")).alias("component_id"))


def keep_one(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the smallest doc_id stays, of rows equal in
    doc_id and component one; every text without words stays."""
    layout = lay_out(docs)
    texts = _stored(text_components(layout, words, percent), "text-components")
    # one (text, id) per component, found by minima over its distinct texts; then one row of those equal in both
    keepers = (texts.where(F.col("n") > 0).groupBy("label").agg(F.min(F.struct("id", "h")).alias("k"))
               .select("k.id", "k.h", F.lit(True).alias("single")))
    wordless = texts.where(F.col("n") == 0).select("h")
    empties = layout.rows.join(wordless, "h").select("id", "h", F.lit(False).alias("single")).distinct()
    rows = docs.select(F.struct("*").alias("row"), row_id(F.col("doc_id")).alias("id"),
                       text_key(F.coalesce(F.col("text"), F.lit(""))).alias("h"))
    kept = rows.join(keepers.unionByName(empties), ["id", "h"])
    once = kept.where("single").groupBy("id", "h").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return once.select("row.*").unionByName(kept.where(~F.col("single")).select("row.*"))
