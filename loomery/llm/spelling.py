"""Spelling variants: a relational trie frontier finds the words at one edit from each word.

A trie of all words is a table: a node is the hash of a prefix, an edge leads
from a node to the next one below it that branches or ends a word, and its label
is the text between. The frontier is a table of states (word, position, node,
edits). It starts where a word's own path meets a branching node: there a near
word must leave the path, by a replaced or an inserted code point,
and the edit is spent; a deleted one is an insertion as the shorter word sees it. Level by level the states join the edges on (node, next
code point) and go on where the whole label agrees with the rest of the word;
one-edit states that end the word at the end of another one become neighbours.

Two words at one edit agree in the first or in the last half of the longer one, so a
second trie holds the reversed words, and in both the frontier starts in a word's second half
only. That bounds what branches: no state starts at the crowded nodes near the
root. A level is one equi-join; their number is that of branching nodes below
the edit (each edge also holds 64 bits for what the words below it go on with, which ends most states early), not that of code points, so words of any length take few levels. Nodes
that share a hash merge, which can only add candidates; an exact distance on the
words themselves decides.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from loomery.llm.store import written

#: Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8 whose capitals are lower already.
RUNS = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
BREAK = re.compile(rb"[\x00-\x60\x7b-\x7f]")
PIECE, HELD = 1 << 20, 400_000


def pieces(text: bytes) -> Iterator[bytes]:
    """Parts of some ``PIECE`` bytes that cut no run."""
    at = 0
    while at < len(text):
        end = BREAK.search(text, at + PIECE)
        yield text[at : end.start() if end else len(text)]
        at = end.start() if end else len(text)


def misspelt(word: bytes, h: int) -> bytes:
    """Without its code point ``h`` modulo its length."""
    text = word.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def counted_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 5, min_count: int = 3, damage: int = 0) -> DataFrame:
    """(word, n): runs of letters with A-Z lower-cased, of ``min_chars`` code points and ``min_count`` occurrences at least.

    With ``damage``, a run whose crc32 of ``<id>:<run>`` it divides loses one code
    point first, the same at every place of a document; a null id is written as nothing.
    A null or empty text has no words; repeated rows count each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            kept = {w: n for w, n in held.items() if len(w) >= 2 * min_chars or len(w.decode()) >= min_chars}
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(kept), pa.binary()).cast(pa.string()), pa.array(list(kept.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for i in range(len(batch)):
                start = zlib.crc32((batch.column(0)[i].as_py() or "").encode() + b":")
                for part in pieces((batch.column(1)[i].as_py() or b"").lower()):
                    found = {w: n for w, n in Counter(RUNS.findall(part)).items() if len(w) >= min_chars}
                    if damage and found:
                        hashes = np.fromiter(map(zlib.crc32, found, repeat(start)), np.int64, len(found))
                        words = list(found)
                        for at in np.flatnonzero(hashes % damage == 0).tolist():
                            n = found.pop(words[at])
                            word = misspelt(words[at], int(hashes[at]))
                            held[word] = held.get(word, 0) + n
                    for word, n in found.items():
                        held[word] = held.get(word, 0) + n
                    if len(held) > HELD:
                        yield out()
        yield out()

    given = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")).where("text is not null")
    return given.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = np.uint64(0x9E3779B97F4A7C15)


def prefix_nodes(words: list[str], back: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, depth, node, next code point or 0 at the end) of every prefix from the middle on, of the reversed words where ``back``."""
    size = np.array([len(w) for w in words], np.int64)
    code = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    first = np.cumsum(size) - size
    row = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(code)) - first[row]
    if back:
        code = code[first[row] + size[row] - 1 - at]
    power = np.full(max(1, int(size.max(initial=0))), BASE, np.uint64)
    power[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(code.astype(np.uint64) + BASE) * np.cumprod(power)[at], dtype=np.uint64)])
    low = np.maximum(size - 1, 0) // 2
    many = size - low + 1
    row = np.repeat(np.arange(len(words)), many)
    depth = np.arange(len(row)) - (np.cumsum(many) - many)[row] + low[row]
    node = _mixed((sums[first[row] + depth] - sums[first[row]]) * BASE + (2 * depth + back).astype(np.uint64))
    after = np.where(depth < size[row], np.append(code, 0)[np.minimum(first[row] + depth, len(code))], 0)
    return row, depth, node.view(np.int64), after


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 2000):
            part = batch.slice(at, 2000)
            ids, words = part.column(0).to_numpy(), part.column(1).to_pylist()
            for back in (False, True):
                row, depth, node, after = prefix_nodes(words, back)
                arrays = [pa.array(ids[row]), pa.array(np.full(len(row), back)), pa.array(depth, pa.int32()), pa.array(node), pa.array(after, pa.int32())]
                yield pa.RecordBatch.from_arrays(arrays, ["wid", "back", "depth", "node", "after"])


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point is all that differs."""
    if len(a) > len(b):
        a, b = b, a
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return len(a) == len(b) > same and a[same + 1 :] == b[same + 1 :] or len(a) + 1 == len(b) and a[same:] == b[same + 1 :]


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        near = [one_edit(a, b) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))


def _from(text: str, at: str) -> Column:
    """The text from a position (counted from 0) on."""
    return F.expr(f"substring({text}, {at} + 1, {text}_size)")


def _signature(text: str, at: str) -> Column:
    """One of 64 bits for what follows a position: the next two code points, and how many are left."""
    return F.expr(f"cast(pmod(xxhash64(substring({text}, {at} + 1, 2), {text}_size - {at}), 64) as int)")


def neighbours(words: DataFrame) -> DataFrame:
    """(wid, other) for each ordered pair of words at one edit; ``words`` has one row a word: wid bigint, word string."""
    prefixes = words.select("wid", "word").mapInArrow(_prefixes, "wid bigint, back boolean, depth int, node bigint, after int")
    branching = prefixes.groupBy("node").agg(F.min("after").alias("a"), F.max("after").alias("z")).where("a <> z").select("node", F.lit(True).alias("branches"))
    stops = prefixes.join(branching, "node", "left").where("branches or after = 0")
    hops = stops.groupBy("wid", "back").agg(F.sort_array(F.collect_list(F.struct("depth", "node"))).alias("hops"))
    s = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))
    paths = written(words.join(hops, "wid").select("wid", s.alias("s"), F.length("word").alias("s_size"), "hops"), "paths")

    steps = paths.selectExpr("s", "s_size", "explode(transform(slice(hops, 1, size(hops) - 1), (h, i) -> struct(h as a, hops[i + 1] as b))) as step")
    label = F.expr("substring(s, step.a.depth + 1, step.b.depth - step.a.depth)").alias("label")
    each = steps.select(F.col("step.a.node").alias("node"), F.col("step.b.node").alias("child"), label, _signature("s", "step.b.depth").alias("bit"))
    edges = written(each.groupBy("node", "child", "label").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("below")), "edges")
    ends = paths.selectExpr("wid as other", "element_at(hops, -1).node as node")

    # a state stays only if some word below its node goes on alike
    hopeful = F.getbit("below", _signature("s", "pos")) == 1
    start = paths.selectExpr("wid", "s", "s_size", "explode(filter(hops, h -> h.depth >= s_size div 2)) as hop").selectExpr("wid", "s", "s_size", "hop.depth as pos", "hop.node as node")
    fork = start.join(edges.withColumn("label_size", F.length("label")), "node").where("substring(label, 1, 1) <> substring(s, pos + 1, 1)")
    # each pair is found from one side: the shorter word, or the one with the smaller code point
    replaced = F.expr("pos < s_size and substring(label, 1, 1) > substring(s, pos + 1, 1)") & F.startswith(_from("s", "(pos + 1)"), _from("label", "1"))
    inserted = F.startswith(_from("s", "pos"), _from("label", "1"))
    to = [F.when(replaced, F.col("pos") + F.col("label_size")), F.when(inserted, F.col("pos") + F.col("label_size") - 1)]
    spent = fork.select("wid", "s", "s_size", F.explode(F.array_compact(F.array(*to))).alias("pos"), F.col("child").alias("node"), "below").where(hopeful).drop("below")
    states = written(spent.withColumn("edits", F.lit(1)), "states")
    ended = [states]
    step = edges.select(F.col("node"), F.substring("label", 1, 1).alias("next"), "label", "child", "below")
    while True:
        ongoing = states.where("pos < s_size").withColumn("next", F.expr("substring(s, pos + 1, 1)"))
        moved = ongoing.join(step, ["node", "next"]).where(F.startswith(_from("s", "pos"), F.col("label")))
        states = written(moved.select("wid", "s", "s_size", (F.col("pos") + F.length("label")).alias("pos"), F.col("child").alias("node"), "edits", "below").where(hopeful).drop("below"), "states")
        if states.isEmpty():
            break
        ended.append(states)
    found = ended[0].where("pos = s_size").select("wid", "node")
    for level in ended[1:]:
        found = found.unionByName(level.where("pos = s_size").select("wid", "node"))
    pairs = found.join(ends, "node").where("wid <> other").select("wid", "other").distinct()
    a, b = words.select("wid", F.col("word").alias("word_a")), words.select(F.col("wid").alias("other"), F.col("word").alias("word_b"))
    joined = pairs.join(a, "wid").join(b, "other").select("wid", "other", "word_a", "word_b")
    near = written(joined.mapInArrow(_checked, "wid bigint, other bigint"), "near")
    return near.unionByName(near.select(F.col("other").alias("wid"), F.col("wid").alias("other")))


def roots(links: DataFrame) -> DataFrame:
    """(wid, root): the last word that forms lead to; ``links`` has wid and form_id (null: none). Pointer doubling: forms at least double in count, so chains and rounds are few."""
    now = written(links.select("wid", F.coalesce("form_id", "wid").alias("root")), "pointers")
    while True:
        moving = now.where("wid <> root")
        ahead = moving.select(F.col("wid").alias("root"), F.col("root").alias("ahead"))
        # only words that have a form can move again
        stepped = written(moving.join(ahead, "root", "left").select("wid", F.coalesce("ahead", "root").alias("root"), F.expr("ahead is not null").alias("moved")), "pointers")
        if stepped.where("moved").isEmpty():
            return now
        now = now.where("wid = root").unionByName(stepped.select("wid", "root"))


def variants(counted: DataFrame) -> DataFrame:
    """Group words by spelling: ``counted`` has one row a word (word string, n bigint); null words are left out.

    Returns word, form, root, n, n_near, form_n. Near words differ by exactly one
    inserted, deleted or replaced code point. The form is the near word of largest
    n, of ties the smallest in code-point order, if its n is at least twice the
    word's own; else null. The root is where forms end, the word itself without a
    form. An empty table gives no rows; further columns are ignored.
    """
    words = written(counted.where("word is not null").select(F.monotonically_increasing_id().alias("wid"), "word", "n"), "words")
    near = neighbours(words).join(words.select(F.col("wid").alias("other"), F.col("word").alias("w"), F.col("n").alias("m")), "other")
    best = near.groupBy("wid").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "w", "other")).alias("best"))
    formed = F.expr("best is not null and -best.m >= 2 * n")
    each = words.join(best, "wid", "left").select("wid", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *(F.when(formed, F.col(f"best.{c}")).alias(a) for c, a in (("w", "form"), ("other", "form_id"))), F.when(formed, -F.col("best.m")).alias("form_n"))
    each = written(each, "forms")
    last = roots(each.select("wid", "form_id")).join(words.select(F.col("wid").alias("root"), F.col("word").alias("root_word")), "root").select("wid", F.col("root_word").alias("root"))
    return each.join(last, "wid").select("word", "form", "root", "n", "n_near", "form_n")
