"""Exact n-gram Jaccard join by a token-group matrix.

1. Every document's set of distinct word shingles is made inside its hashed
   group; sets with too few shingles that occur in other documents can link
   with nothing and end here. Equal sets become one class.
2. Classes that share one of a few min-hashes are compared with one leader of
   that min-hash (the one with the largest share of tokens that others hold: a
   copied original before its edited copies). What is linked has one label.
3. Two sets of sizes a and b are linked only if percent (a + b) / (100 + percent)
   tokens are common. So a class whose tokens are held under other labels often
   enough in no range of sizes can gain no link (``sifted``). This is what ends
   copies of one original that are too far from each other, without a pair.
4. The rest is partitioned into groups of similar classes: those of one label, or
   single ones with the same leader, of similar size, ``GROUP_CLASSES`` in each. The
   token-group matrix says which group holds a token; a class looks in it for its
   rarest tokens (a linked class must hold one of them among its own rarest).
5. Each group gets the classes that found it. The overlap of a class with the
   group's token union bounds its overlap with any member; only groups that reach
   the required overlap are opened and compared member by member.

Every bound is a necessary condition, so no two components that a link joins stay
apart. Groups and their queries are dealt in bounded portions, a large cluster too.

Semantics: A-Z are lower-cased; a text of fewer words than a shingle has its
whole sequence as one; texts without words (null, empty) have no shingles and
link with nothing. Rows of one id are separate documents; a null id sorts first
and a component of which it is the smallest has a null component_id. Extra
columns are ignored.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm import groups as G
from tenderlake.llm import words as W
from tenderlake.llm.components import connected
from tenderlake.llm.storage import Scratch, materialize

SETS = "doc_id long, n_shingles long, sig binary, tokens array<long>"
REFINED = "cls long, n_shingles long, tokens array<long>, mins array<long>"
SIFTED = "cls long, label long, loose boolean, leader long, n_shingles long, tokens array<long>, look long"
SIFTED_COLUMNS = ["cls", "label", "loose", "leader", "n_shingles", "tokens", "look"]
REACH = 7  #: ranges of sizes between a set and the largest that can be linked with it
SPAN = REACH + 1  #: ranges looked at on either side, with one to spare for rounding
GROUP_CLASSES = 128  #: classes of a group of the matrix
PORTION = 2048  #: classes that ask for a group in one portion


def shingle_sets(table: pa.Table, words: int):
    """Sorted distinct shingle hashes of each text, in the table's order."""
    for _, w in G.text_slices(table, lower=True):
        h = w.hashes()
        full, _ = W.windows(h, w.doc, words, seed=words)
        for i, j in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
            if j - i >= words:
                yield np.unique(full[i : j - words + 1])
            elif j > i:
                yield W.windows(h[i:j], w.doc[i:j], j - i, seed=j - i)[0]
            else:
                yield np.zeros(0, np.uint64)


def signature(tokens: np.ndarray) -> bytes:
    return b"".join(np.bitwise_xor.reduce(W.mix(tokens * c)).tobytes() for c in W.constants(2, 77)) + len(tokens).to_bytes(8, "little")


def lists(arrays) -> pa.ListArray:
    flat = np.concatenate([*arrays, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(t) for t in arrays]), pa.int32()), pa.array(flat, pa.int64()))


def set_rows(ids, sizes, sigs, tokens) -> pa.Table:
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_shingles": pa.array(sizes, pa.int64()), "sig": pa.array(sigs, pa.binary()), "tokens": lists(tokens)})


def tokens_of(table: pa.Table) -> list[np.ndarray]:
    column = table["tokens"].combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column
    if not len(table):
        return []
    flat, ends = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
    return [flat[i:j] for i, j in zip(ends[:-1], ends[1:])]


def sparse_sets(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """A row for each document; sig and tokens (those that occur in other documents) only where a link is possible."""
    lay = G.layout(docs, text_col)
    dealt = G.grouped(docs, lay, id_col, text_col)

    def tell(table: pa.Table) -> pa.Table:
        keys = G.short_key(np.concatenate(list(shingle_sets(table, words))), lay.buckets)
        return G.presence(keys, np.zeros(len(keys), bool), table[G.GROUP][0].as_py())

    def sift(table: pa.Table, answers: pa.Table) -> pa.Table:
        hits, rows = G.keys_in(answers), []
        for doc, tokens in zip(table["doc_id"].to_pylist(), shingle_sets(table, words)):
            often = G.member(G.short_key(tokens, lay.buckets), hits)
            if len(tokens) and 100 * int(often.sum()) >= percent * len(tokens):
                rows.append((doc, len(tokens), signature(tokens), tokens[often]))
            else:
                rows.append((doc, len(tokens), None, np.zeros(0, np.uint64)))
        return set_rows(*zip(*rows)) if rows else set_rows([], [], [], [])

    told = G.shared(dealt.groupBy(G.GROUP).applyInArrow(tell, G.PACKED), need_mark=False)
    return dealt.groupBy(G.GROUP).cogroup(told.groupBy(G.GROUP)).applyInArrow(sift, SETS)


def refine(classes: DataFrame, lay: G.Layout, percent: int, seeds: int) -> DataFrame:
    """Classes that still can link, with the tokens that other classes hold and their min-hashes."""
    dealt = classes.select(F.pmod("cls", F.lit(lay.groups)).cast("int").alias(G.GROUP), "cls", "n_shingles", "tokens")
    multipliers = W.constants(seeds, 5)

    def tell(table: pa.Table) -> pa.Table:
        keys = G.short_key(np.concatenate(tokens_of(table)), lay.buckets)
        return G.presence(keys, np.zeros(len(keys), bool), table[G.GROUP][0].as_py())

    def sift(table: pa.Table, answers: pa.Table) -> pa.Table:
        hits, rows = G.keys_in(answers), []
        for cls, size, tokens in zip(table["cls"].to_pylist(), table["n_shingles"].to_pylist(), tokens_of(table)):
            often = G.member(G.short_key(tokens, lay.buckets), hits)
            if 100 * int(often.sum()) >= percent * size:
                tokens = tokens[often]
                rows.append((cls, size, tokens, np.array([W.mix(tokens ^ c).min() for c in multipliers])))
        cls, size, tokens, mins = zip(*rows) if rows else ([], [], [], [])
        return pa.table({"cls": pa.array(cls, pa.int64()), "n_shingles": pa.array(size, pa.int64()), "tokens": lists(tokens), "mins": lists(mins)})

    told = G.shared(dealt.groupBy(G.GROUP).applyInArrow(tell, G.PACKED), need_mark=False)
    return dealt.groupBy(G.GROUP).cogroup(told.groupBy(G.GROUP)).applyInArrow(sift, REFINED)


@dataclass(frozen=True)
class Sizes:
    """Ranges of set sizes, ``REACH`` of them between a size and the largest that it can be linked with."""

    percent: int

    @property
    def step(self) -> float:
        return max(np.log(100 / self.percent), 0.01) / REACH

    def range_of(self, size: np.ndarray) -> np.ndarray:
        return np.floor(np.log(np.maximum(size, 1)) / self.step + 1e-9).astype(np.int64)

    def least(self, range_: np.ndarray) -> np.ndarray:
        """No size of the range is smaller."""
        return np.ceil(np.exp(range_ * self.step) * (1 - 1e-6))

    def need(self, size: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Common tokens without which sets of these sizes, or larger others, are not linked."""
        return np.ceil(np.maximum(size * self.percent / 100, (size + other) * self.percent / (100 + self.percent)) - 1e-6)


def sifted(wide: DataFrame, lay: G.Layout, percent: int) -> DataFrame:
    """Classes that can gain a link, with their tokens held under other labels, rarest first, and how many of these to look for.

    wide: cls, label, n_shingles, tokens. The matrix travels packed: each task
    sends the tokens of its classes by bucket, with label and size range, and
    learns for each of its tokens in which neighbouring ranges another label holds
    it, and how many classes hold it in all.
    """
    sizes = Sizes(percent)
    dealt = wide.select(F.pmod("cls", F.lit(lay.groups)).cast("int").alias(G.GROUP), "cls", "label", "loose", "leader", "n_shingles", "tokens")

    def entries(table: pa.Table):
        """Distinct (token, label, size range) of a group in order, and which of them each token of the classes is."""
        tokens = tokens_of(table)
        n = [len(t) for t in tokens]
        key = G.short_key(np.concatenate(tokens), lay.buckets)
        label, range_ = np.repeat(table["label"].to_numpy(), n), np.repeat(sizes.range_of(table["n_shingles"].to_numpy()), n)
        order = np.lexsort((range_, label, key))
        k, x, r = key[order], label[order], range_[order]
        fresh = np.concatenate([[True], (k[1:] != k[:-1]) | (x[1:] != x[:-1]) | (r[1:] != r[:-1])])[: len(k)]
        of = np.zeros(len(k), np.int64)
        of[order] = np.cumsum(fresh) - 1
        times = np.bincount(of, minlength=int(fresh.sum()))
        return k[fresh], x[fresh], r[fresh].astype(np.int32), np.minimum(times, 2**31 - 1).astype(np.int32), of

    def tell(table: pa.Table) -> pa.Table:
        key, label, range_, times, _ = entries(table)
        low = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return G.packed((key >> np.uint64(32)).astype(np.int64), table[G.GROUP][0].as_py(), low, lambda i, j: label[i:j].tobytes() + range_[i:j].tobytes() + times[i:j].tobytes())

    def meet(table: pa.Table) -> pa.Table:
        lows = [np.frombuffer(x, np.uint32) for x in table["hashes"].to_pylist()]
        extra, n = table["extra"].to_pylist(), [len(x) for x in lows]
        label = np.concatenate([np.frombuffer(x, np.int64, k) for x, k in zip(extra, n)])
        range_ = np.concatenate([np.frombuffer(x, np.int32, k, 8 * k) for x, k in zip(extra, n)]).astype(np.int64)
        times = np.concatenate([np.frombuffer(x, np.int32, k, 12 * k) for x, k in zip(extra, n)]).astype(np.int64)
        low = np.concatenate(lows)
        order = np.argsort(low, kind="stable")
        at, run = G.runs(low[order])
        token = np.zeros(len(low), np.int64)
        token[order] = np.repeat(np.arange(len(at)), run)
        holders = np.bincount(token, times, len(at))[token]
        span = int(range_.max(initial=0)) + 2 * SPAN + 2
        key = token * span + range_ + SPAN
        order = np.argsort(key, kind="stable")
        at, _ = G.runs(key[order])
        held = key[order][at]
        first, last = np.minimum.reduceat(label[order], at), np.maximum.reduceat(label[order], at)
        where = np.zeros(len(low), np.uint32)
        for step in range(2 * SPAN + 1):
            there = np.minimum(np.searchsorted(held, key + (step - SPAN)), len(held) - 1)
            other = (held[there] == key + (step - SPAN)) & ((first[there] != label) | (last[there] != label))
            where |= other.astype(np.uint32) << np.uint32(step)
        ends = np.cumsum(n)
        rare = np.minimum(holders, 2**32 - 1).astype(np.uint32)
        rows = [where[e - k : e].tobytes() + rare[e - k : e].tobytes() for e, k in zip(ends, n)]
        return pa.table({G.GROUP: table[G.GROUP], G.BUCKET: table[G.BUCKET], "hashes": pa.array(rows, pa.binary())})

    def sift(table: pa.Table, answers: pa.Table) -> pa.Table:
        key, _, _, _, of = entries(table)
        replies = sorted(zip(answers[G.BUCKET].to_pylist(), answers["hashes"].to_pylist()))  # the order in which entries were sent
        where = np.concatenate([np.frombuffer(x, np.uint32, len(x) // 8) for _, x in replies] + [np.zeros(0, np.uint32)])[of]
        rare = np.concatenate([np.frombuffer(x, np.uint32, len(x) // 8, len(x) // 2) for _, x in replies] + [np.zeros(0, np.uint32)])[of]
        rows, at = [], 0
        meta = zip(*(table[c].to_pylist() for c in ("cls", "label", "loose", "leader", "n_shingles")))
        for (cls, label, loose, leader, size), tokens in zip(meta, tokens_of(table)):
            own, often = where[at : at + len(tokens)], rare[at : at + len(tokens)]
            at += len(tokens)
            ranges = sizes.range_of(np.array([size]))[0] + np.arange(-SPAN, SPAN + 1)
            need = sizes.need(np.full(len(ranges), size), sizes.least(ranges))
            count = np.array([int((own >> np.uint32(step) & np.uint32(1)).sum()) for step in range(len(ranges))])
            can = np.flatnonzero(count >= need)
            if not len(can):
                continue
            useful = (own & np.uint32(sum(1 << int(step) for step in can))) > 0
            tokens, often = tokens[useful], often[useful]
            order = np.lexsort((tokens, often))
            rows.append((cls, label, loose, leader, size, tokens[order], len(tokens) - int(need[can].min()) + 1))
        cls, label, loose, leader, size, tokens, look = zip(*rows) if rows else ([],) * 7
        numbers = {"cls": cls, "label": label, "leader": leader, "n_shingles": size, "look": look}
        return pa.table({k: pa.array(v, pa.int64()) for k, v in numbers.items()} | {"loose": pa.array(loose, pa.bool_()), "tokens": lists(tokens)}).select(SIFTED_COLUMNS)

    answer = f"{G.GROUP} int, {G.BUCKET} int, hashes binary"
    told = dealt.groupBy(G.GROUP).applyInArrow(tell, G.PACKED).groupBy(G.BUCKET).applyInArrow(meet, answer)
    return dealt.groupBy(G.GROUP).cogroup(told.groupBy(G.GROUP)).applyInArrow(sift, SIFTED)


def linked(a_size, b_size, common, percent: int):
    return F.lit(100) * common >= F.lit(percent) * (a_size + b_size - common)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs a, b of classes that are linked."""
    a = sets.select(F.col("cls").alias("a"), F.col("n_shingles").alias("a_size"), F.col("tokens").alias("a_tokens"))
    b = sets.select(F.col("cls").alias("b"), F.col("n_shingles").alias("b_size"), F.col("tokens").alias("b_tokens"))
    both = pairs.join(a, "a").join(b, "b").where(F.lit(100) * F.least("a_size", "b_size") >= F.lit(percent) * F.greatest("a_size", "b_size"))
    return both.where(linked(F.col("a_size"), F.col("b_size"), F.size(F.array_intersect("a_tokens", "b_tokens")), percent)).select("a", "b")


def led(sets: DataFrame) -> DataFrame:
    """Columns a, b, seed: each class with the leaders of its min-hashes, one row a class and seed."""
    own = (F.size("tokens") / F.col("n_shingles")).alias("own")
    keyed = sets.select("cls", own, F.posexplode("mins").alias("seed", "least"))
    leaders = keyed.groupBy("seed", "least").agg(F.min_by("cls", F.struct(-F.col("own"), "cls")).alias("b"))
    return keyed.join(leaders, ["seed", "least"]).select(F.col("cls").alias("a"), "b", "seed")


def found_groups(rest: DataFrame) -> DataFrame:
    """Distinct (cls, grp): the groups that hold one of the tokens a class looks for among those their classes look for.

    Single classes look for all groups, those of a label for groups of lesser
    labels only: one side of each pair of labels is enough.
    """
    rare = rest.select("cls", "grp", "label", "loose", F.explode(F.slice("tokens", F.lit(1), F.col("look").cast("int"))).alias("token"))
    index = rare.select("token", F.col("grp").alias("other"), F.col("label").alias("owner"), F.col("loose").alias("single"))
    index = index.withColumn("owner", F.when(~F.col("single"), F.col("owner"))).distinct()
    ask = (F.col("loose") & (F.col("single") | (F.col("label") != F.col("owner")))) | (~F.col("single") & (F.col("label") > F.col("owner")))
    return rare.join(index, "token").where(ask).select("cls", F.col("other").alias("grp")).distinct()


def open_groups(asking: DataFrame, rest: DataFrame, percent: int) -> DataFrame:
    """Linked labels a, b; asking: cls, grp. Groups meet their queries in portions of ``PORTION`` classes."""
    sizes = Sizes(percent)
    columns = ("cls", "label", "n_shingles", "tokens")
    salt = F.pmod(F.xxhash64("cls"), F.col("portions")).alias("portion")
    portions = asking.groupBy("grp").agg(F.ceil(F.count("*") / F.lit(PORTION)).alias("portions"))
    queries = asking.join(portions, "grp").select("grp", salt, "cls").join(rest.select(*columns), "cls")
    members = rest.join(portions, "grp").withColumn("portion", F.explode(F.sequence(F.lit(0).cast("long"), F.col("portions") - 1))).select("grp", "portion", *[F.col(c).alias(c) for c in columns])  # names of their own, for the cogroup

    def compare(group: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if len(group) and len(asked):
            own, label, size = tokens_of(group), group["label"].to_numpy(), group["n_shingles"].to_numpy()
            member, token = np.repeat(np.arange(len(own)), [len(t) for t in own]), np.concatenate(own)
            order = np.argsort(token, kind="stable")
            token, member = token[order], member[order]
            union, n = G.runs(token)
            held = token[union]
            for ask, ask_size, tokens in zip(asked["label"].to_pylist(), asked["n_shingles"].to_pylist(), tokens_of(asked)):
                fits = (100 * size >= percent * ask_size) & (100 * ask_size >= percent * size) & (label != ask)
                if not fits.any():
                    continue
                at = np.minimum(np.searchsorted(held, tokens), len(held) - 1)
                at = at[held[at] == tokens]
                if len(at) < sizes.need(ask_size, size[fits].min()):
                    continue  # not even the union has enough
                common = np.bincount(member[G.spans(union[at], n[at])], minlength=len(own))
                hit = fits & (100 * common >= percent * (size + ask_size - common))
                found.extend((ask, x) for x in np.unique(label[hit]).tolist())
        a, b = zip(*set(found)) if found else ([], [])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return members.groupBy("grp", "portion").cogroup(queries.groupBy("grp", "portion")).applyInArrow(compare, "a long, b long").distinct()


def _components(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, seeds: int, scratch: Scratch) -> DataFrame:
    rows = scratch.table(sparse_sets(docs, id_col, text_col, words, percent), "sets")
    maybe = rows.where("sig is not null")
    classes = maybe.groupBy("sig").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(int(G.NO_ID))).alias("doc_id"), "n_shingles", "tokens")).alias("c"))
    # numbered as written: the table has one number for each set, whatever the hashes
    classes = scratch.table(classes.select(F.monotonically_increasing_id().alias("cls"), "sig", "c.doc_id", "c.n_shingles", "c.tokens"), "classes")
    names = classes.select("cls", "sig", "doc_id")
    token_bytes = 8 * (classes.agg(F.sum(F.size("tokens"))).first()[0] or 0)
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lay = G.Layout(max(least, token_bytes >> 23), max(least, token_bytes >> 24))
    sets = scratch.table(refine(classes, lay, percent, seeds), "refined")

    leaders = scratch.table(led(sets), "leaders")
    labels = connected(verified(leaders.where("a <> b").select("a", "b").distinct(), sets, percent), scratch)
    labels = labels.select(F.col("node").alias("cls"), "label")
    own = sets.select("cls", "n_shingles", "tokens").join(labels, "cls", "left").join(leaders.where("seed = 0").select(F.col("a").alias("cls"), F.col("b").alias("leader")), "cls")
    wide = own.select("cls", F.coalesce("label", "cls").alias("label"), F.col("label").isNull().alias("loose"), "leader", "n_shingles", "tokens")
    rest = scratch.table(sifted(wide, lay, percent), "rest")

    # groups: one label or one leader, similar sizes, a bounded number of classes
    range_ = F.floor(F.log(F.col("n_shingles")) / F.lit(float(Sizes(percent).step)))
    kin = rest.select("cls", "loose", F.when(F.col("loose"), F.col("leader")).otherwise(F.col("label")).alias("kin"), range_.alias("range"))
    parts = kin.groupBy("loose", "kin", "range").agg(F.ceil(F.count("*") / F.lit(GROUP_CLASSES)).alias("parts"))
    grp = F.xxhash64("loose", "kin", "range", F.pmod(F.xxhash64("cls"), F.col("parts")))
    rest = scratch.table(rest.join(kin.join(parts, ["loose", "kin", "range"]).select("cls", grp.alias("grp")), "cls"), "grouped")

    asking = scratch.table(found_groups(rest), "asking")
    joined = connected(open_groups(asking, rest, percent), scratch)
    whole = labels.union(joined.join(labels.select(F.col("cls").alias("node")), "node", "left_anti").select(F.col("node"), F.col("node")))
    whole = whole.join(joined.select(F.col("node").alias("label"), F.col("label").alias("last")), "label", "left").select("cls", F.coalesce("last", "label").alias("label"))
    named = scratch.table(names.join(whole, "cls", "left").select("sig", "doc_id", F.coalesce("label", "cls").alias("label")), "named")
    least_id = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_set = named.join(least_id, "label").select("sig", "component_id")
    alone = rows.where("sig is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    grouped = maybe.join(of_set, "sig").select("doc_id", "n_shingles", F.nullif("component_id", F.lit(int(G.NO_ID))).alias("component_id"))
    return alone.union(grouped)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75, seeds: int = 3) -> DataFrame:
    """Columns: doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    with Scratch(docs.sparkSession, "jaccard") as scratch:
        return materialize(_components(docs, id_col, text_col, words, percent, seeds, scratch), "components")


def query(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS p FROM words WHERE len(w) > 0
), shingles AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 4), ' ') AS s FROM starts
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
), common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (SELECT x, y FROM common c JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c.n >= 75 * (p.n + q.n - c.n)
), ends AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (SELECT x AS doc_id, x AS other FROM ends UNION SELECT r.doc_id, b.y FROM reach r JOIN ends b ON b.x = r.other
), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.doc_id = d.doc_id
"""
