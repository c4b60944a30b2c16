"""Secret scans in DataFrame expressions only: patterns, and sliding-window entropy of candidate strings.

Spark's regular expressions return matched strings, not places. Places come from cutting the text at
the same matches: the pieces between them and the matches alternate, so running sums of their lengths are the offsets. Only texts
that a pattern occurs in are cut.

Candidates are runs of token characters with a letter and a digit. As a key's name or a path may be joined to a key by a sign, the pieces
between '=' and those between all signs are judged too, as if they stood alone. A piece's class gives the window length and the entropy that a
window must reach; a piece shorter than the window is one window, with the bound in proportion to the logarithm of its length. The counts of
the characters in the window are five bits each, packed into a few long integers, and changed by the character that enters and the one
that leaves; so is the sum of c * log2(c), from which the window's entropy is log2(n) - sum / n.

No step takes the square of a text's matches: running sums and maxima are built in blocks, and expressions that are needed for each
element are bound to a variable first.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Patterns in the order of their rank: name, pattern, group whose length counts, and that length.
KINDS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
#: A run of 20 or more token characters that has a letter and a digit.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[0-9+/_=-]*[A-Za-z])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}"
#: Pieces of a run that are judged like runs: without '=', and without any sign.
PIECES = (r"[A-Za-z0-9+/_-]{20,}", r"[A-Za-z0-9]{20,}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Counts of up to 31, packed into long integers.
BITS, PER_WORD = 5, 12
WORDS = -(-len(ALPHABET) // PER_WORD)


@dataclass(frozen=True)
class CharacterClass:
    """Candidates that match ``pattern``, the window's length, and the least entropy of a full window in bits per character."""

    pattern: str
    window: int
    entropy: float


#: The first class that a candidate matches is its class.
CLASSES = (
    CharacterClass("^[0-9A-Fa-f]+$", 20, 3.0),
    CharacterClass("^[A-Z0-9]+$|^[a-z0-9]+$", 20, 3.5),
    CharacterClass("^[A-Za-z0-9]+$", 20, 3.7),
    CharacterClass("^[A-Za-z0-9+/_=-]+$", 24, 3.9),
)
#: A part between signs that has one of these is no secret, and a run is cut there: placeholders, counting runs.
ALLOW_PARTS = r"(?<![A-Za-z0-9])[A-Za-z0-9]*?(?:(?i:example|placeholder|changeme|dummy|sample|xxxx)|0123456789|(?i:abcdefgh))[A-Za-z0-9]*[+/_=-]*"
#: A candidate or piece that matches this is no secret: UUIDs.
ALLOW = "(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
#: Words and numbers joined by signs are no secret: they start with a letter or digit, and no letter stands beside a digit.
_STARTS_PLAIN, _MIXED = "^[A-Za-z0-9]", "[A-Za-z][0-9]|[0-9][A-Za-z]"

#: Elements of a running sum that are summed anew for each of them.
BLOCK = 128


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """array<int>: for each value the sum (or what ``join`` makes, starting from 0) of those before it.

    Blocks are joined first; what comes before a block is known then, and the rest is joined within the block.
    """
    over = lambda xs: F.aggregate(xs, F.lit(0), join)

    def blocks(v: Column) -> Column:
        count = F.ceil(F.size(v) / BLOCK).cast("int")
        return F.transform(F.filter(F.sequence(F.lit(0), count), lambda b: b < count), lambda b: F.slice(v, b * BLOCK + 1, F.lit(BLOCK)))

    def heads(cut: Column) -> Column:
        """What comes before each block; the list grows by one per block."""
        start = F.struct(F.lit(0).alias("upto"), F.array().cast("array<int>").alias("out"))
        step = lambda s, x: F.struct(join(s["upto"], x).alias("upto"), F.concat(s["out"], F.array(s["upto"])).alias("out"))
        return F.aggregate(F.transform(cut, over), start, step, lambda s: s["out"])

    def inner(z: Column) -> Column:
        return F.transform(z["values"], lambda _, i: F.aggregate(F.slice(z["values"], F.lit(1), i), z["head"], join))

    whole = lambda cut: F.flatten(F.transform(F.arrays_zip(cut.alias("values"), heads(cut).alias("head")), inner))
    return _let(values, lambda v: _let(blocks(v), whole))


def _places(text: Column, pattern: str, group: int) -> Column:
    """array<struct<start, end, size, value>> of all matches, leftmost first; ``size`` is the group's length."""
    kind = "array<struct<start:int,end:int,size:int,value:string>>"

    def found(matches: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
        sized = matches if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        rows = F.transform(
            F.arrays_zip(matches.alias("m"), gaps.alias("g"), sized.alias("s")),
            lambda x: F.struct(F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("long"), F.length(x["s"]).alias("size"), x["m"].alias("value")),
        )
        return _let(rows, placed)

    def placed(rows: Column) -> Column:
        before = _running(F.transform(rows, lambda x: x["gap"] + x["long"]), lambda a, b: a + b)
        return F.transform(
            F.arrays_zip(rows.alias("r"), before.alias("before")),
            lambda z: F.struct(
                (z["before"] + z["r"]["gap"]).alias("start"), (z["before"] + z["r"]["gap"] + z["r"]["long"]).alias("end"),
                z["r"]["size"].alias("size"), z["r"]["value"].alias("value"),
            ),
        ).cast(kind)

    all_matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(F.regexp(text, F.lit(pattern)), _let(all_matches, found)).otherwise(F.array().cast(kind))


def _log_term(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count)).otherwise(0.0)


def _stretches(run: Column) -> Column:
    """array<struct<at, value>>: what lies between the run's allowed parts, if it has 20 characters or more."""
    starts = F.concat(F.array(F.lit(0)), F.transform(_places(run, ALLOW_PARTS, 0), lambda x: x["end"]))
    found = F.arrays_zip(starts.alias("at"), F.split(run, ALLOW_PARTS, -1).alias("value"))
    return F.filter(found, lambda x: F.length(x["value"]) >= 20)


def _pieces(run: Column) -> Column:
    """array<struct<at, value>>: the run and its pieces that have a letter and a digit, each once."""
    kind = "array<struct<at:int,value:string>>"
    parts = lambda p: F.transform(_places(run, p, 0), lambda x: F.struct(x["start"].alias("at"), x["value"].alias("value"))).cast(kind)
    # A piece without '=' that has no other sign either is found among those without any sign.
    signed = F.filter(parts(PIECES[0]), lambda x: F.regexp(x["value"], F.lit("[+/_-]")))
    pieces = _let(F.length(run), lambda whole: F.filter(F.concat(signed, parts(PIECES[1])), lambda x: F.length(x["value"]) < whole))
    pieces = F.concat(F.array(F.struct(F.lit(0).alias("at"), run.alias("value"))).cast(kind), pieces)
    return F.filter(pieces, lambda x: F.regexp(x["value"], F.lit("[A-Za-z]")) & F.regexp(x["value"], F.lit("[0-9]")))


def _merged(spans: Column, kind: str) -> Column:
    """Spans by start, those that overlap as one: one begins where no earlier span reaches, and ends where the next one finds that all have ended."""

    def begins(ordered: Column) -> Column:
        reach = _running(F.transform(ordered, lambda x: x["end"]), lambda a, b: F.greatest(a, b))
        zipped = F.arrays_zip(ordered.alias("s"), reach.alias("reach"))
        last = F.array_max(F.transform(ordered, lambda x: x["end"]))
        return _let(F.filter(zipped, lambda z: z["s"]["start"] >= z["reach"]), lambda first: _let(last, lambda end: F.transform(first, joined(first, end))))

    def joined(first: Column, last: Column):
        def one(z: Column, i: Column) -> Column:
            end = F.coalesce(F.get(first, i + 1)["reach"], last)
            return F.struct(z["s"]["start"].alias("start"), z["s"]["rank"].alias("rank"), end.alias("end"))

        return one

    return _let(F.array_sort(spans), begins).cast(kind)


def _outside(spans: Column, others: Column, kind: str) -> Column:
    """The spans that lie within none of the others: of those that start no later, none reaches their end."""
    tag = lambda n: lambda x: F.struct(x["start"].alias("start"), F.lit(n).alias("own"), x["end"].alias("end"), x["rank"].alias("rank"))
    both = F.array_sort(F.concat(F.transform(others, tag(0)), F.transform(spans, tag(1))))

    def kept(ordered: Column) -> Column:
        reach = _running(F.transform(ordered, lambda x: F.when(x["own"] == 0, x["end"]).otherwise(0)), lambda a, b: F.greatest(a, b))
        zipped = F.arrays_zip(ordered.alias("s"), reach.alias("reach"))
        open_ = F.filter(zipped, lambda z: (z["s"]["own"] == 1) & (z["reach"] < z["s"]["end"]))
        return F.transform(open_, lambda z: F.struct(z["s"]["start"].alias("start"), z["s"]["rank"].alias("rank"), z["s"]["end"].alias("end")))

    return _let(both, kept).cast(kind)


def _dense_span(value: Column) -> Column:
    """struct<first, last>: the first and the end of the last window whose entropy reaches its class's bound, null if none does."""
    matches = [F.regexp(value, F.lit(c.pattern)) for c in CLASSES]
    chosen = F.lit(None).cast("struct<window:int,entropy:double>")
    for c, m in reversed(list(zip(CLASSES, matches))):
        window = F.least(F.lit(c.window), F.length(value))
        bound = F.lit(c.entropy) * (F.log2(window) / F.log2(F.lit(c.window)))
        chosen = F.when(m, F.struct(window.alias("window"), bound.alias("entropy"))).otherwise(chosen)
    places = F.transform(F.filter(F.split(value, ""), lambda ch: ch != ""), lambda ch: F.instr(F.lit(ALPHABET), ch) - 1)
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), WORDS).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("i"),
        F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"), chosen.alias("c"),
    )
    shift = lambda char: (char % PER_WORD) * BITS
    word = lambda char: F.floor(char / PER_WORD).cast("int")

    def count_of(counts: Column, char: Column) -> Column:
        return F.call_function("shiftright", F.get(counts, word(char)), shift(char)).bitwiseAND(F.lit((1 << BITS) - 1).cast("long"))

    def step(s: Column, x: Column) -> Column:
        # The state is copied at each step, so it must stay small: the character that leaves comes with the one that enters.
        char, leaving = x["enters"], x["leaves"]
        same = F.coalesce(leaving == char, F.lit(False))
        entered = count_of(s["counts"], char) + 1
        left = F.coalesce(count_of(s["counts"], leaving), F.lit(0).cast("long"))
        total = F.when(same, s["sum"]).otherwise(
            s["sum"] + _log_term(entered) - _log_term(entered - 1) - _log_term(left) + _log_term(left - 1)
        )
        one = lambda char, j: F.when(word(char) == j, F.call_function("shiftleft", F.lit(1).cast("long"), shift(char))).otherwise(F.lit(0).cast("long"))
        counts = F.when(same, s["counts"]).otherwise(F.transform(s["counts"], lambda n, j: n + one(char, j) - one(leaving, j)))
        full = s["i"] + 1 >= s["c"]["window"]
        dense = full & (F.log2(s["c"]["window"]) - total / s["c"]["window"] >= s["c"]["entropy"])
        return F.struct(
            counts.alias("counts"), total.alias("sum"), (s["i"] + 1).alias("i"),
            F.when(dense & s["first"].isNull(), s["i"] + 1 - s["c"]["window"]).otherwise(s["first"]).alias("first"),
            F.when(dense, s["i"] + 1).otherwise(s["last"]).alias("last"), s["c"].alias("c"),
        )

    def moves(chars: Column) -> Column:
        """Each character with the one that leaves the window for it; null until the window is full."""
        left = F.concat(F.array_repeat(F.lit(None).cast("int"), chosen["window"]), chars)
        return F.arrays_zip(chars.alias("enters"), F.slice(left, F.lit(1), F.size(chars)).alias("leaves"))

    ends = lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"))
    found = F.aggregate(_let(places, moves), start, step, ends)
    plain = F.regexp(value, F.lit(_STARTS_PLAIN)) & ~F.regexp(value, F.lit(_MIXED))
    return F.when(~(F.regexp(value, F.lit(ALLOW)) | plain), found)


def _joined(spans: Column, names: list[str]) -> Column:
    """'kind:start:end' of all spans, by start and then rank."""
    label = lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, names)), x["rank"]), x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), label), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the number of each kind, ``base`` (spans of the patterns) and ``spans`` (with those of high entropy).

    Spans read kind:start:end in code points, end exclusive, comma-joined by start and then kind. Matches of a kind don't overlap; a match
    that is too short is dropped, and the search goes on behind it. Spans of high entropy that overlap are one; inside a pattern's span they are
    not told again.
    Null and empty texts have none, repeated rows get a row each, other columns are ignored.
    """
    names = [*[k[0] for k in KINDS], "entropy"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    kind = "array<struct<start:int,rank:int,end:int>>"

    def spanned(rank: int):
        return lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"))

    def long_enough(least: int):
        return lambda x: x["size"] >= least

    for rank, (name, pattern, group, least) in enumerate(KINDS, 1):
        fit = F.filter(_places(F.col("text"), pattern, group), long_enough(least))
        rows = rows.withColumn(name, F.transform(fit, spanned(rank)).cast(kind))
    rows = rows.withColumn("runs", _places(F.col("text"), CANDIDATE, 0)).drop("text")
    base = F.concat(*[F.col(n) for n in names[:-1]])

    def cut(runs: Column, into) -> Column:
        return F.flatten(
            F.transform(
                runs, lambda x: F.transform(into(x["value"]), lambda y: F.struct((x["at"] + y["at"]).alias("at"), y["value"].alias("value")))
            )
        )

    runs = F.transform("runs", lambda x: F.struct(x["start"].alias("at"), x["value"].alias("value")))
    pieces = cut(cut(runs, _stretches), _pieces)
    dense = F.transform(pieces, lambda x: F.struct(x["at"].alias("at"), _dense_span(x["value"]).alias("w")))
    dense = F.filter(dense, lambda x: x["w"]["first"].isNotNull())
    dense = F.transform(
        dense, lambda x: F.struct((x["at"] + x["w"]["first"]).alias("start"), F.lit(len(names)).alias("rank"), (x["at"] + x["w"]["last"]).alias("end"))
    ).cast(kind)
    rows = rows.select("doc_id", *names[:-1], base.alias("found"), F.when(F.size("runs") > 0, dense).otherwise(F.array().cast(kind)).alias("dense"))
    told = F.when(F.size("dense") > 0, _outside(_merged(F.col("dense"), kind), F.col("found"), kind)).otherwise(F.array().cast(kind))
    return rows.select(
        "doc_id", *[F.size(n).cast("long").alias(f"n_{n}") for n in names[:-1]],
        _joined(F.col("found"), names).alias("base"), _joined(F.concat("found", told), names).alias("spans"),
    )
