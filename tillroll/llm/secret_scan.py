"""Secrets in text: fixed forms, and strings whose characters look random.

Fixed forms are found by pattern, leftmost and without overlap for each kind.
Further candidates are all runs of sixteen key characters or more. A window
slides over each, with a count for each character: one goes down and one up at
every step, and the entropy follows from these two. A run in which some window
is over the limit of the run's character class is a span from end to end, unless
it is within a span of a fixed form. The allow-list takes out the windows that
it covers: those of digits or of the alphabet alone, and all windows of a run
that is a UUID or made of natural words and short numbers.

Everything is a column expression. Entropy is kept as whole numbers, so that it
is the same in any engine. Positions count code points, ends are exclusive.

Null and empty texts have no spans. A text of any length is taken whole; the
work grows with its length. Each row gives one row, whatever its id; columns
besides doc_id and text are ignored by `scan` and kept by `redact`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import floor, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import set_aside


@dataclass(frozen=True)
class Kind:
    """`group` is the part of the match that must have `least` characters."""

    name: str
    pattern: str
    group: int
    least: int


_WORDS = "password|passwd|secret|token|api_?key"


def any_case(words: str) -> str:
    """A pattern for `words` in either case of A-Z alone."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


# The forms of secrets, in the order in which kinds are listed.
KINDS = (
    Kind(
        "assign",
        rf"({any_case(_WORDS)})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 18),
    # Whole runs, so asking for the length in the pattern finds the same ones.
    Kind("hex", r"[0-9a-f]{16,}", 0, 16),
)

ENTROPY = "entropy"
WINDOW = 16
# A whole run of key characters.
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
# Character class -> what all characters are, and the bits per character that are too many.
CLASSES = (
    ("hex", r"^[0-9a-fA-F]+=*$", 2.8),
    ("word", r"^([A-Z]?[a-z]+|[A-Z]+)=*$", 3.7),
    ("letters", r"^[A-Za-z]+=*$", 3.5),
    ("lower", r"^[0-9a-z_-]+=*$", 3.4),
    ("base64", r"^[A-Za-z0-9+/_=-]+$", 3.5),
)
# Runs that look random and are not: UUIDs, and words and short numbers with separators.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^/?((([A-Z]?[a-z]+|[A-Z]+)[0-9]{0,4}|[0-9]{1,4})[/_=-])+([A-Z]?[a-z]*|[A-Z]+)[0-9]{0,4}$",
)
# Windows that are not: numbers, and pieces of the alphabet in either case.
ALLOWED_WINDOW = r"^[0-9+/_=-]+$"
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
SCALE = 1 << 16


def weight(count: int) -> int:
    """count * log2(count), scaled; a window's entropy is log2(size) - sum of weights / size."""
    return floor(count * log2(count) * SCALE + 0.5) if count else 0


def limit(bits: float, window: int) -> int:
    """The largest sum of weights at which a window has more than `bits` per character."""
    return floor((log2(window) - bits) * window * SCALE)


_SPANS = "array<struct<kind:string,start:int,end:int>>"
_MATCHES = "array<struct<start:int,hit:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is evaluated once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"), start.cast("int").alias("start"), end.cast("int").alias("end")
    )


def _placed(text: Column, pattern: str, group: int, keep: Callable[[Column], Column]) -> Column:
    """(start, hit) of the matches of `pattern` whose `group` passes `keep`.

    The gaps between the matches and the matches take turns, so their lengths
    tell where each match starts.
    """
    columns = {
        "gap": F.split(text, pattern, -1),
        "hit": F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        "part": F.regexp_extract_all(text, F.lit(pattern), F.lit(group)),
    }
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_MATCHES).alias("out"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        hit = F.struct(start.cast("int").alias("start"), x["hit"].alias("hit"))
        kept = F.concat(state["out"], F.array(hit))
        return F.struct(
            (start + F.coalesce(F.length(x["hit"]), F.lit(0))).cast("int").alias("at"),
            F.when(keep(x["part"]), kept).otherwise(state["out"]).alias("out"),
        )

    zipped = F.arrays_zip(*[c.alias(n) for n, c in columns.items()])
    return F.aggregate(zipped, empty, step, lambda s: s["out"])


def _fixed(text: Column, kind: Kind) -> Column:
    found = _placed(text, kind.pattern, kind.group, lambda part: F.length(part) >= kind.least)
    return F.transform(
        found, lambda m: _span(kind.name, m["start"], m["start"] + F.length(m["hit"]))
    )


def _may_have(text: Column, kind: Kind) -> Column:
    """Tests that spare most texts the search for places."""
    if kind.name == "assign":
        return (text.contains(":") | text.contains("=")) & text.rlike(kind.pattern)
    if kind.name == "access":
        return text.contains("AKIA")
    return text.rlike(kind.pattern)


def base_spans(text: Column) -> Column:
    """Spans of the fixed forms by start, then kind as listed."""
    none = F.array().cast(_SPANS)
    found = [F.when(_may_have(text, k), _fixed(text, k)).otherwise(none) for k in KINDS]
    return in_order(F.concat(*found))


def is_random(hit: Column, window: int = WINDOW) -> Column:
    """Whether some window of `hit` is over its limit and not on the allow-list.

    `hit` has at least `window` characters.
    """
    most = F.lit(-1)
    for _, form, bits in reversed(CLASSES):
        most = F.when(hit.rlike(form), F.lit(limit(bits, window))).otherwise(most)
    weights = F.array(*[F.lit(weight(c)) for c in range(window + 1)])
    gains = F.array(*[F.lit(weight(c + 1) - weight(c)) for c in range(window)])

    def over(total: Column, x: Column, at: Column) -> Column:
        text = F.substring(x["hit"], at + 1, window)
        covered = text.rlike(ALLOWED_WINDOW) | F.contains(F.lit(ALPHABET), F.lower(text))
        return (total <= x["most"]) & ~covered

    def search(x: Column) -> Column:
        letters, kinds = x["letters"], x["kinds"]

        def slide(state: Column, at: Column) -> Column:
            """From the window that starts at `at` to the next: one count less, one more."""
            leaves = F.array_position(kinds, F.element_at(letters, at)).cast("int")
            enters = F.array_position(kinds, F.element_at(letters, at + window)).cast("int")
            moved = F.transform(
                state["counts"],
                lambda c, i: c - (i + 1 == leaves).cast("int") + (i + 1 == enters).cast("int"),
            )

            def next_state(counts: Column) -> Column:
                lost = F.element_at(gains, F.element_at(state["counts"], leaves))
                won = F.element_at(gains, F.element_at(counts, enters))
                total = (state["sum"] - lost + won).cast("int")
                found = state["found"] | over(total, x, at)
                return F.struct(
                    counts.alias("counts"), total.alias("sum"), found.alias("found")
                )

            return _let(moved, next_state)

        def opening(counts: Column) -> Column:
            total = F.aggregate(
                counts, F.lit(0), lambda t, c: (t + F.element_at(weights, c + 1)).cast("int")
            )
            return F.struct(
                counts.alias("counts"),
                total.alias("sum"),
                over(total, x, F.lit(0)).alias("found"),
            )

        first = F.slice(letters, 1, window)
        counts = F.transform(kinds, lambda k: F.size(F.filter(first, lambda c: c == k)))
        more = F.size(letters) > window
        steps = F.when(more, F.sequence(F.lit(1), F.size(letters) - window))
        none = F.array().cast("array<int>")
        return F.aggregate(
            F.coalesce(steps, none), _let(counts, opening), slide, lambda s: s["found"]
        )

    def spread(letters: Column) -> Column:
        kinds = F.array_distinct(letters)
        fields = {"letters": letters, "kinds": kinds, "hit": hit, "most": most}
        return _let(F.struct(*[c.alias(n) for n, c in fields.items()]), search)

    return _let(F.split(hit, ""), spread)


def _allowed(hit: Column) -> Column:
    found = F.lit(False)
    for form in ALLOWED:
        found = found | hit.rlike(form)
    return found


def entropy_spans(text: Column, base: Column, window: int = WINDOW) -> Column:
    """Spans of random-looking strings that no span of `base` holds, by start."""

    def keep(hit: Column) -> Column:
        return ~_allowed(hit) & is_random(hit, window)

    def span(m: Column) -> Column:
        return _span(ENTROPY, m["start"], m["start"] + F.length(m["hit"]))

    def known(e: Column) -> Column:
        return F.exists(base, lambda b: (b["start"] <= e["start"]) & (b["end"] >= e["end"]))

    spans = F.transform(_placed(text, CANDIDATE, 0, keep), span)
    found = F.filter(spans, lambda e: ~known(e))
    return F.when(text.rlike(CANDIDATE), found).otherwise(F.array().cast(_SPANS))


def in_order(spans: Column) -> Column:
    """By start, then kind as listed, the entropy's last."""
    kinds = F.array(*[F.lit(k.name) for k in KINDS], F.lit(ENTROPY))
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.array_position(kinds, s["kind"]).alias("rank"),
            s["end"].alias("end"),
        ),
    )
    return F.transform(
        F.array_sort(keyed),
        lambda s: F.struct(
            F.element_at(kinds, s["rank"].cast("int")).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
        ),
    )


def with_spans(docs: DataFrame, text: str, base: str, spans: str) -> DataFrame:
    """`docs` with two columns of spans: of the fixed forms, and all."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = docs.withColumn(base, base_spans(whole))
    more = entropy_spans(whole, F.col(base))
    return found.withColumn(spans, more).withColumn(
        spans, in_order(F.concat(F.col(base), F.col(spans)))
    )


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans): arrays of (kind, start, end)."""
    return with_spans(docs.select("doc_id", "text"), "text", "base", "spans").drop("text")


def spelt(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(one, ",")


def redact(docs: DataFrame, marker: str = "[secret]") -> DataFrame:
    """`docs` with every stretch of spans replaced by `marker`; null texts stay null.

    `n_chars` becomes the new length where there is such a column and a secret.
    """
    named = set_aside(docs, "text", "n_chars")
    text = F.col("text")
    found = with_spans(named, "text", "_base", "_spans").drop("_base")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def cut(state: Column, s: Column) -> Column:
        apart = s["start"] >= state["at"]
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.concat(
                state["out"], F.when(apart, F.concat(gap, F.lit(marker))).otherwise("")
            ).alias("out"),
        )

    clean = F.aggregate(
        F.col("_spans"),
        start,
        cut,
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))),
    )
    found = found.withColumn("_hit", F.size("_spans") > 0)
    found = found.withColumn("text", F.when(F.col("_hit"), clean).otherwise(text))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(F.col("_hit"), length).otherwise(F.col("n_chars")))
    return found.select(*named.columns).toDF(*docs.columns)
