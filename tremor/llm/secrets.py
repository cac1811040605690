"""Secret scan with SQL functions only.

Base kinds (assign, access, hex) are the leftmost non-overlapping matches of their
pattern that pass a length check; they are always kept.  Offsets come from the
pieces between the matches: a match starts where the lengths of the pieces and
matches before it end.

The kind ``random`` adds long tokens that look like encoded random bytes.  A token's
alphabet is inferred (hex, letters of one case or both, base32, base36, base62, base64); plain numbers have none.  Three tests ask whether its
characters could be uniform draws: a chi-squared test of the alphabet's
frequencies, a runs test about the middle of the alphabet and the lag-1
serial correlation; Fisher's rule joins the three p-values.

Tokens that are surely not random are dropped, under false-discovery control
(Benjamini-Hochberg at level ``Q``) over all tokens of the table, separately for
each doubling of the token length, because short tokens carry less evidence.  The
p-values are counted in ``BINS`` logarithmic bins per length class, so the threshold
table has a bounded size.  The level bounds the share of truly random tokens among those dropped.  How many others are
reported is not bounded by it: among made-up identifiers of 20 and more characters about 8 % are (``tests/llm``), none in the test tables' texts.
Tokens that overlap a base span are not added.

Positions come from sums over stretches of matches, so a text with very many matches costs in proportion to them.

Offsets are code points, end exclusive.  Null and empty texts have no spans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tremor.session import cut_lineage

Q = 0.05
BINS = 400
LEAST = 20
STRETCH = 128

ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{14,}"      # a run of 18 or more: shorter runs hold no longer match
HEX = r"[0-9a-f]{16,}"             # likewise
TOKEN = r"[A-Za-z0-9+/_=-]{%d,}" % LEAST

KINDS = ("assign", "access", "hex", "random")
_HEX, _UPPER, _LOWER, _DIGITS = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: name: (condition on the token t, alphabet); the first that holds counts
ENCODINGS = {
    "hex": ("t RLIKE '^([0-9a-f]+|[0-9A-F]+)$'", _HEX),
    "letters of one case": ("t RLIKE '^([a-z]+|[A-Z]+)$'", _LOWER),
    "letters": ("t RLIKE '^[a-zA-Z]+$'", _UPPER + _LOWER),
    "base32": ("t RLIKE '^[A-Z2-7]+=*$'", _UPPER + "234567"),
    "base36": ("t RLIKE '^([0-9a-z]+|[0-9A-Z]+)$'", _DIGITS + _LOWER),
    "base62": ("t RLIKE '^[0-9A-Za-z]+$'", _DIGITS + _UPPER + _LOWER),
    "base64": ("true", _DIGITS + _UPPER + _LOWER + "+/"),
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used inside."""
    return F.get(F.transform(F.array(value), body), 0)


def _before(values: Column, zero: int, join: Callable[[Column, Column], Column]) -> Column:
    """For each place of an array of longs, all values before it joined.  Places are taken in stretches, whose joins are joined in turn, so
    the cost per place does not grow with its number (but for one join per stretch)."""
    start = F.lit(zero).cast("long")

    def stretches(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / STRETCH).cast("int")),
                           lambda c: F.aggregate(F.slice(v, c * STRETCH + 1, STRETCH), start, join))

    def places(v: Column) -> Column:
        return _let(stretches(v), lambda s: _let(
            F.transform(s, lambda x, c: F.aggregate(F.slice(s, F.lit(1), c), start, join)),
            lambda first: F.transform(v, lambda x, i: F.aggregate(
                F.slice(v, F.floor(i / STRETCH).cast("int") * STRETCH + 1, i % STRETCH), F.get(first, F.floor(i / STRETCH).cast("int")), join))))

    return _let(values, lambda v: F.when(F.size(v) > 0, places(v)).otherwise(F.array().cast("array<bigint>")))


def _spans(text: Column, pattern: str, found: Column, kind: int, group: int | None = None) -> Column:
    """All matches as array<struct<start, kind, end, text>>; text is that of ``group``.  ``found`` is a cheap
    condition without which there is no match."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = whole if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("match"), inner.alias("text"))
    rows = F.filter(rows, lambda r: r["match"].isNotNull())
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,text:string>>")

    def placed(rs: Column) -> Column:
        lengths = F.transform(rs, lambda r: (F.length(r["gap"]) + F.length(r["match"])).cast("long"))

        def one(at: Column, r: Column) -> Column:
            start = at + F.length(r["gap"])
            return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(r["match"])).alias("end"), r["text"].alias("text"))

        return F.zip_with(_before(lengths, 0, lambda x, y: x + y), rs, one)

    return F.when(found, _let(rows, placed)).otherwise(empty)


def _apart(tokens: Column, base: Column) -> Column:
    """The tokens (structs with start and end) that overlap no base span, both in any order, by start."""
    mark = lambda c, own: F.transform(c, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(own).alias("own"),
                                                            s["class"].alias("class") if own else F.lit(-1).alias("class"),
                                                            s["bin"].alias("bin") if own else F.lit(-1).alias("bin")))
    far = (1 << 62)

    def kept(m: Column) -> Column:
        ends = F.transform(m, lambda s: F.when(s["own"], F.lit(-1)).otherwise(s["end"]).cast("long"))
        starts = F.reverse(F.transform(m, lambda s: F.when(s["own"], F.lit(far)).otherwise(s["start"]).cast("long")))
        ahead = F.reverse(_before(starts, far, lambda x, y: F.least(x, y)))
        both = F.arrays_zip(m.alias("s"), _before(ends, -1, lambda x, y: F.greatest(x, y)).alias("end"), ahead.alias("next"))
        return F.transform(F.filter(both, lambda r: r["s"]["own"] & (r["end"] <= r["s"]["start"]) & (r["next"] >= r["s"]["end"])), lambda r: r["s"])

    return _let(F.array_sort(F.concat(mark(base, False), mark(tokens, True))), kept)


def _alphabet() -> str:
    cases = " ".join(f"WHEN {cond} THEN '{abc}'" for cond, abc in ENCODINGS.values())
    return f"CASE WHEN t RLIKE '[A-Za-z]' THEN CASE {cases} END END"


#: (start, end, t) -> symbols of the token as numbers in its alphabet of size a
_SYMBOLS = f"""
transform(filter(transform(tokens, r -> named_struct('start', r.start, 'end', r.end, 't', r.text)),
                 r -> length(r.t) >= {LEAST}),
  r -> named_struct('start', r.start, 'end', r.end, 'abc', {_alphabet().replace('t RLIKE', 'r.t RLIKE')}, 't', r.t))
"""
_NUMBERS = """
transform(filter(tokens, r -> r.abc IS NOT NULL), r -> named_struct('start', r.start, 'end', r.end, 'a', length(r.abc),
  'x', filter(transform(split(if(length(r.abc) IN (16, 26, 36), lower(r.t), translate(r.t, '-_=', '+/')), ''),
                        c -> if(c = '', 0, instr(r.abc, c))), v -> v > 0)))
"""
#: counts behind the three tests: n, sum of squared symbol counts, number above the middle, runs, mean
_COUNTS = """
transform(filter(tokens, r -> size(r.x) >= 16), r -> named_struct('start', r.start, 'end', r.end, 'a', double(r.a), 'n', double(size(r.x)),
  'squares', aggregate(transform(array_distinct(r.x), v -> double(size(filter(r.x, w -> w = v)))), 0D, (s, c) -> s + c * c),
  'high', aggregate(r.x, 0D, (s, v) -> s + if(2 * v > r.a, 1D, 0D)),
  'runs', 1D + aggregate(zip_with(slice(r.x, 1, size(r.x) - 1), slice(r.x, 2, size(r.x) - 1),
                                  (v, w) -> if((2 * v > r.a) != (2 * w > r.a), 1D, 0D)), 0D, (s, v) -> s + v),
  'sum', aggregate(r.x, 0D, (s, v) -> s + v),
  'sum2', aggregate(r.x, 0D, (s, v) -> s + double(v) * v),
  'cross', aggregate(zip_with(slice(r.x, 1, size(r.x) - 1), slice(r.x, 2, size(r.x) - 1), (v, w) -> double(v) * w), 0D, (s, v) -> s + v),
  'ends', double(element_at(r.x, 1) + element_at(r.x, -1))))
"""
#: normal scores of the three tests
_SCORES = """
transform(tokens, r -> named_struct('start', r.start, 'end', r.end, 'n', r.n,
  'z1', (power(greatest(r.a * r.squares / r.n - r.n, 0D) / (r.a - 1), 1D / 3) - 1 + 2 / (9 * (r.a - 1))) / sqrt(2 / (9 * (r.a - 1))),
  'z2', if(r.high = 0 OR r.high = r.n, 8D,
           abs(r.runs - 1 - 2 * r.high * (r.n - r.high) / r.n)
           / sqrt(greatest(2 * r.high * (r.n - r.high) * (2 * r.high * (r.n - r.high) - r.n) / (r.n * r.n * (r.n - 1)), 1e-9D))),
  'z3', if(r.sum2 - r.sum * r.sum / r.n <= 1e-9D, 8D,
           sqrt(r.n) * abs(r.cross - (r.sum / r.n) * (2 * r.sum - r.ends) + (r.n - 1) * (r.sum / r.n) * (r.sum / r.n))
           / (r.sum2 - r.sum * r.sum / r.n))))
"""


def _tail(z: str) -> str:
    """Upper tail of the normal distribution (a logistic curve with a cubic term)."""
    z = f"least(greatest({z}, -8D), 8D)"
    return f"1 / (1 + exp(1.5976D * {z} + 0.07056D * {z} * {z} * {z}))"


#: Fisher's rule: with y the sum of -log p, the tail of chi-squared with 6 degrees of freedom
_JOINED = f"""
transform(transform(tokens, r -> named_struct('start', r.start, 'end', r.end, 'n', r.n,
    'y', -ln({_tail('r.z1')}) - ln(least(1D, 2 * {_tail('r.z2')})) - ln(least(1D, 2 * {_tail('r.z3')})))),
  r -> named_struct('start', r.start, 'end', r.end, 'class', int(floor(log2(r.n))),
    'bin', int(least({BINS - 1}, floor(10 * (r.y - ln(1 + r.y + r.y * r.y / 2)) / ln(10D))))))
"""


def battery(df: DataFrame, column: str = "tokens") -> DataFrame:
    """From array<struct<start, kind, end, text>> to array<struct<start, end, class, bin>>: the length class of each
    token and its p-value as a bin, -10 log10 p."""
    df = df.withColumnRenamed(column, "tokens") if column != "tokens" else df
    for step in (_SYMBOLS, _NUMBERS, _COUNTS, _SCORES, _JOINED):
        df = df.withColumn("tokens", F.expr(step))
    return df


def thresholds(tokens: DataFrame, q: float = Q) -> DataFrame:
    """(class, cut): bins from ``cut`` on are rejected by Benjamini-Hochberg within each length class.
    At most 32 classes of ``BINS`` bins."""
    sizes = tokens.groupBy("class", "bin").count()
    down = Window.partitionBy("class").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = sizes.select("class", "bin", F.sum("count").over(down).alias("rank"),
                          F.sum("count").over(Window.partitionBy("class")).alias("m"))
    holds = F.pow(F.lit(10.0), -F.col("bin") / 10) * F.col("m") <= q * F.col("rank")
    return ranked.where(holds).groupBy("class").agg(F.min("bin").alias("cut"))


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = Q) -> DataFrame:
    """One row per row of ``docs``: doc_id, spans (array of start, kind number in KINDS, end; by start, then kind)."""
    text = F.coalesce(docs[text_col], F.lit(""))
    base = docs.select(docs[id_col].alias("doc_id"), text.alias("text"))
    t = F.col("text")
    found = base.select(
        "doc_id",
        F.filter(_spans(t, ASSIGN, F.rlike(t, F.lit(ASSIGN)), 0, 2), lambda s: F.length(s["text"]) >= 12).alias("assign"),
        _spans(t, ACCESS, F.contains(t, F.lit("AKIA")), 1).alias("access"),
        _spans(t, HEX, F.rlike(t, F.lit("[0-9a-f]{16}")), 2).alias("hex"),
        _spans(t, TOKEN, F.rlike(t, F.lit(TOKEN)), 3).alias("tokens"))
    bare = lambda c: F.transform(c, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    found = found.select("doc_id", F.concat(*[bare(F.col(k)) for k in KINDS[:3]]).alias("base"), "tokens")
    # no texts from here on: a small table, read by the threshold count and the result
    found = cut_lineage(battery(found))
    cuts = thresholds(found.select(F.explode("tokens").alias("r")).select("r.class", "r.bin"), q)
    cut = {r["class"]: r["cut"] for r in cuts.collect()}  # at most 32 rows
    limit = F.create_map(*[F.lit(x) for kv in cut.items() for x in kv]) if cut else None
    likely = F.filter("tokens", lambda r: F.lit(True) if limit is None else F.coalesce(r["bin"] < limit[r["class"]], F.lit(True)))
    added = F.transform(_apart(likely, F.col("base")), lambda r: F.struct(r["start"].alias("start"), F.lit(3).alias("kind"), r["end"].alias("end")))
    return found.select("doc_id", F.array_sort(F.concat("base", added)).alias("spans"))


def op6_secrets(docs: DataFrame) -> DataFrame:
    found = secrets(docs)
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))
    count = lambda n: F.size(F.filter("spans", lambda s: s["kind"] == n)).cast("long")
    return found.select(
        "doc_id", *[count(n).alias(f"n_{k}") for n, k in enumerate(KINDS)],
        F.sha2(F.concat_ws(",", F.transform(F.filter("spans", lambda s: s["kind"] < 3), shown)).cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", shown)).alias("spans"))
