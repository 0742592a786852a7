"""Personal data by base patterns and bootstrapped contexts, with built-in functions only.

Base spans come from regular expressions: matches are fenced by a private-use
character, and the text is split there into gaps and matches in turn; running sums
of their lengths give the places. All patterns are loops over single characters (a
joining character between two that it joins is first swapped for a private-use one),
so that long runs take neither deep recursion nor quadratic time.

Contexts: texts are seen as tokens, runs of non-blanks with every delimiter as a
token of its own, in lower case and with each digit as 0. A lexical pattern is a
window of tokens around a slot (``WINDOWS``: up to three on the left, on the right
or on both sides). An instance is a value in a slot: a base span, or any other
value with a digit or an @. Seeds are the base spans and values whose shape alone
tells a credential (``SECRET_SHAPES``).

Patterns and instances form a graph, which is scored in rounds. A pattern's weight
is the scores of the instances at its occurrences, summed, over all the occurrences
that its window has in the corpus, whatever stands in the slot. It is accepted with
``support`` distinct instances of positive score and a weight of ``confidence`` or
more. An instance scores 1 if it is a seed, else as its best accepted pattern. Values
in a slot of a pattern accepted in the last round are spans of kind ``id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loomery.llm.store import written

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
#: A joining character, and the fence of a match; private use, and put out of the way where a text has them.
MARK, FENCE, SPARE = "\ue000", "\ue002", "\ue001"

LABEL = "A-Za-z0-9-"
LOCAL = "A-Za-z0-9._%+-"
JOINING = {"email": rf"(?<=[{LABEL}])\.(?=[{LABEL}])", "card": r"(?<=[0-9])[ -](?=[0-9])"}
PATTERN = {
    "email": rf"(?:(?<![{MARK}{LOCAL}])|\G)[{MARK}{LOCAL}]++@[{LABEL}]++{MARK}[{MARK}{LABEL}]*+",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": rf"(?<![0-9{MARK}])[0-9][0-9{MARK}]++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
MUST_HOLD = {"email": "@", "ip": ".", "card": None, "phone": "+"}
OCTETS = r"\A0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}\z"

#: Delimiters beside blanks; each is a token.
DELIMITERS = "\"'<>()[]{},;=:"
SIGNS = r"\x22'<>()\[\]{},;=:"
#: A candidate value: no delimiter, at least one digit or @, not in the middle of a run.
VALUE = rf"(?<![^\s{SIGNS}])[^\s{SIGNS}0-9@]*+[0-9@][^\s{SIGNS}]*+"
#: Shapes of credentials: hexadecimal digests and keys, UUIDs, long mixed runs of the base64 alphabets.
SECRET_SHAPES = (
    r"\A(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{32,}\z",
    r"\A(?=[0-9]*[A-F])(?=[A-F]*[0-9])[0-9A-F]{32,}\z",
    r"\A[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}\z",
    r"\A(?=[^a-z]*[a-z])(?=[^A-Z]*[A-Z])(?=[^0-9]*[0-9])[A-Za-z0-9_+/-]{28,}={0,2}\z",
)
#: Tokens left and right of a slot that make a pattern.
WINDOWS = ((1, 0), (2, 0), (3, 0), (1, 1), (2, 1), (0, 2), (0, 3))
REACH = 3
#: Characters of a gap that are tried first for the tokens at its end.
TRIED = 160


def _luhn(digits: Column) -> Column:
    """Whether the check sum of a string of digits is a multiple of ten."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d: F.try_to_number(d, F.lit("9")).cast("int"))
    doubled = F.transform(
        F.filter(each, lambda d: d.isNotNull()),
        lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def tokens(text: Column) -> Column:
    """Lower-case tokens: runs of non-blanks, each delimiter alone, digits as 0."""
    out = F.translate(F.lower(text), "123456789\t\n\x0b\x0c\r", "000000000     ")
    for sign in DELIMITERS:
        out = F.replace(out, F.lit(sign), F.lit(f" {sign} "))
    return F.array_remove(F.split(out, " "), "")


def _edge(gap: Column, last: bool) -> Column:
    """Up to ``REACH`` tokens of a gap at one end, nearest first, without a token that the gap's border cuts."""
    part = F.substring(gap, -TRIED, TRIED) if last else F.substring(gap, 1, TRIED)
    border = F.substring(gap, -1, 1) if last else F.substring(gap, 1, 1)
    skip = F.when((gap == "") | border.rlike(rf"[\s{SIGNS}]"), 1).otherwise(2)
    inward = (lambda t: F.reverse(t)) if last else (lambda t: t)
    short = inward(tokens(part))
    # the last token of a part may be cut; where the others don't suffice the whole gap is looked at
    enough = (F.length(gap) <= TRIED) | (F.size(short) > REACH + 1)
    return F.slice(F.when(enough, short).otherwise(inward(tokens(gap))), skip, REACH)


def _pieces(docs: DataFrame) -> DataFrame:
    """row, doc_id, kind, pos, size, value, head, tail: gaps (even pos) and matches (odd pos), valid or not, and a row of kind -1 for each document."""
    digits = F.col("text").rlike("[0-9]")
    holds = {"email": F.col("text").contains("@"), "ip": digits, "card": digits, "phone": F.col("text").contains("+"), "other": digits | F.col("text").contains("@")}
    parts = [F.struct(F.lit(-1).alias("kind"), F.array(F.lit("")).alias("pieces"))]
    for number, kind in enumerate((*KINDS, "other")):
        given = F.translate("text", MARK + FENCE, SPARE + SPARE)
        if kind in JOINING:
            given = F.regexp_replace(given, JOINING[kind], MARK)
        fenced = F.regexp_replace(given, PATTERN.get(kind, VALUE), f"{FENCE}$0{FENCE}")
        parts.append(F.struct(F.lit(number).alias("kind"), F.when(holds[kind], F.split(fenced, FENCE)).otherwise(F.array().cast("array<string>")).alias("pieces")))
    each = docs.select("row", "doc_id", F.explode(F.array(*parts)).alias("part")).where("part.kind < 0 or size(part.pieces) > 1")
    each = each.select("row", "doc_id", "part.kind", F.posexplode("part.pieces").alias("pos", "piece"))
    piece = F.when(F.col("kind") == 0, F.translate("piece", MARK, ".")).otherwise(F.col("piece"))
    each = each.select("row", "doc_id", "kind", "pos", F.length("piece").alias("size"), piece.alias("piece"), (F.col("pos") % 2 == 1).alias("match"))
    head, tail = (F.when(~F.col("match") & (F.col("kind") >= 0), _edge(F.col("piece"), last)) for last in (False, True))
    return each.select("row", "doc_id", "kind", "pos", "size", F.when(F.col("match"), F.col("piece")).alias("value"), head.alias("head"), tail.alias("tail"))


def _valid(least_length: int) -> Column:
    """Whether a match of its kind counts."""
    value, digits = F.col("value"), F.regexp_replace("value", "[^0-9]", "")
    card = F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    return (
        F.when(F.col("kind") == 0, True)
        .when(F.col("kind") == 1, value.rlike(OCTETS))
        .when(F.col("kind") == 2, card)
        .when(F.col("kind") == 3, F.length(digits).between(9, 15))
        .otherwise(F.length(value) >= least_length)
    )


def _placed(pieces: DataFrame, least_length: int) -> DataFrame:
    """row, kind, start, end, value, before, after of what counts; other values never overlap base spans."""
    order = Window.partitionBy("row", "kind").orderBy("pos")
    end = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int")
    each = pieces.where("kind >= 0").withColumns({"end": end, "before": F.lag("tail").over(order), "after": F.lead("head").over(order)})
    each = each.where(F.col("pos") % 2 == 1).withColumn("start", F.col("end") - F.col("size"))
    short = F.regexp_replace("value", r"[.!?]+\z", "")
    value = F.when(F.col("kind") == OTHER, short).when(F.col("kind").isin(2, 3), F.regexp_replace("value", "[^0-9.+]", "")).otherwise(F.col("value"))
    cut = F.when(F.col("kind") == OTHER, F.col("start") + F.length(short)).otherwise(F.col("end"))
    good = each.where(_valid(least_length)).select("row", "kind", "start", cut.alias("end"), value.alias("value"), "before", "after")
    base = F.col("kind") < OTHER
    up, down = (Window.partitionBy("row").orderBy(o).rangeBetween(Window.unboundedPreceding, Window.currentRow) for o in (F.col("start"), F.col("start").desc()))
    clear = good.withColumn("left", F.max(F.when(base, F.col("end"))).over(up)).withColumn("right", F.min(F.when(base, F.col("start"))).over(down))
    free = (F.coalesce("left", F.lit(0)) <= F.col("start")) & (F.coalesce("right", F.col("end")) >= F.col("end")) & (F.col("end") - F.col("start") >= least_length)
    return clear.where(base | free).drop("left", "right")


def _windows() -> list[tuple[Column, Column]]:
    """(pattern, context) of every window, null where tokens lack; pattern is a 64-bit hash of the window's tokens."""
    out = []
    for number, (left, right) in enumerate(WINDOWS):
        before, after = [f"l{i}" for i in range(left, 0, -1)], [f"r{i}" for i in range(1, right + 1)]
        there = F.lit(True)
        for n in (*before, *after):
            there = there & F.col(n).isNotNull()
        out.append((F.when(there, F.xxhash64(F.lit(number), *before, *after)), F.concat_ws(" ", *before, F.lit("_"), *after)))
    return out


def _occurrences(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(pattern, total): how often the windows of ``wanted`` stand around any token of the texts."""
    each = docs.select(tokens(F.col("text")).alias("t")).select("t", F.posexplode("t").alias("i", "slot")).where(~F.col("slot").isin(*DELIMITERS))
    sides = [F.get("t", F.col("i") + step * k).alias(f"{side}{k}") for side, step in (("l", -1), ("r", 1)) for k in range(1, REACH + 1)]
    found = each.select(*sides).select(F.explode(F.array(*(p for p, _ in _windows()))).alias("pattern")).where("pattern is not null")
    return found.join(wanted.select("pattern"), "pattern").groupBy("pattern").agg(F.count("*").alias("total"))


def score_graph(graph: DataFrame, totals: DataFrame, rounds: int, support: int, confidence: float) -> DataFrame:
    """(pattern, weight, held) of the patterns accepted in the last round.

    ``graph``: (pattern, value, n occurrences, seed); ``totals``: (pattern, total),
    occurrences of the window with anything in its slot.
    """
    whole = graph.groupBy("pattern").agg(F.sum("n").alias("own")).join(totals, "pattern", "left")
    whole = whole.select("pattern", F.greatest("own", F.coalesce("total", F.lit(0))).alias("total"))
    edges = written(graph.join(whole, "pattern"), "graph")
    accepted, scores = None, None
    for _ in range(rounds):
        known = F.lit(0.0) if scores is None else F.coalesce("known", F.lit(0.0))
        scored = (edges if scores is None else edges.join(scores, "value", "left")).withColumn("score", F.when(F.col("seed"), 1.0).otherwise(known))
        weighed = scored.groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("score")) / F.max("total")).alias("weight"), F.sum((F.col("score") > 0).cast("int")).alias("held")
        )
        accepted = written(weighed.where((F.col("held") >= support) & (F.col("weight") >= confidence)), "accepted")
        scores = written(edges.join(accepted, "pattern").groupBy("value").agg(F.max("weight").alias("known")), "scores")
    return accepted


def learn(docs: DataFrame, placed: DataFrame, rounds: int = 3, support: int = 5, confidence: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Accepted patterns (pattern, context, weight, held), and the spans (row, start, end) they discover outside base spans."""
    unproven = F.col("kind") == OTHER
    for shape in SECRET_SHAPES:
        unproven = unproven & ~F.col("value").rlike(shape)
    near = [F.get("before", F.lit(i - 1)).alias(f"l{i}") for i in range(1, REACH + 1)] + [F.get("after", F.lit(i - 1)).alias(f"r{i}") for i in range(1, REACH + 1)]
    instances = placed.select("row", "kind", "start", "end", "value", (~unproven).alias("seed"), *near)
    windows = F.array(*(F.struct(p.alias("pattern"), c.alias("context")) for p, c in _windows()))
    edges = written(instances.select("row", "kind", "start", "end", "value", "seed", F.inline(windows)).where("pattern is not null"), "instances")
    graph = edges.groupBy("pattern", "value").agg(F.count("*").alias("n"), F.max("seed").alias("seed"), F.min("context").alias("context"))
    wanted = written(graph.groupBy("pattern").agg(F.count("*").alias("values"), F.min("context").alias("context")).where(F.col("values") >= support), "wanted")
    graph = written(graph.drop("context").join(wanted.select("pattern"), "pattern"), "edges")
    totals = written(_occurrences(docs, wanted), "totals")
    accepted = score_graph(graph, totals, rounds, support, confidence)
    found = edges.where(F.col("kind") == OTHER).join(accepted, "pattern", "left_semi").select("row", "start", "end").distinct()
    return accepted.join(wanted.select("pattern", "context"), "pattern"), found


def _listed(kinds: tuple[str, ...], spans: Column) -> Column:
    names = F.array(*map(F.lit, kinds))
    each = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


def extract(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, support: int = 5, confidence: float = 0.5, least_length: int = 6
) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_id, n_spans for every row.

    Places are code points, end exclusive. A null text counts as empty. n_id
    counts the spans that contexts added, n_spans all; added ones never overlap base
    spans, and every base span stays. Values under ``least_length`` characters are
    not added. Repeated rows give repeated rows, a null id is kept, an empty table
    gives none; further columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    given = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    pieces = written(_pieces(given.withColumn("row", F.monotonically_increasing_id())), "pieces")
    placed = written(_placed(pieces, least_length), "placed")
    _, found = learn(given, placed, rounds, support, confidence)

    spans = placed.where(F.col("kind") < OTHER).select("row", "kind", "start", "end").unionByName(found.select("row", F.lit(OTHER).alias("kind"), "start", "end"))
    # a document's spans lie in its own text, so their list is no longer than that
    of = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("spans"))
    out = pieces.where("kind < 0").select("row", "doc_id").join(of, "row", "left").select("doc_id", F.coalesce("spans", F.array().cast("array<struct<kind:int,start:int,end:int>>")).alias("all"))
    base = F.filter("all", lambda s: s["kind"] < OTHER)
    number = lambda k: F.size(F.filter("all", lambda s: s["kind"] == k)).cast("bigint")
    names = (*KINDS, "id")
    return out.select(
        "doc_id",
        *(number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
        F.sha2(_listed(names, base), 256).alias("base_sha256"),
        _listed(names, F.col("all")).alias("spans"),
        number(OTHER).alias("n_id"),
        F.size("all").cast("bigint").alias("n_spans"),
    )
