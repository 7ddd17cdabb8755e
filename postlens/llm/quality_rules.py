"""Quality rules: a table of thresholds compiled into one projection.

Words are runs of other characters than ASCII white space, lines are split at ``\\n``. A rule bounds the share of one
measure in another, in per cent, and is compared in whole numbers. A text of null counts as empty and fails; any
other column may be null or missing. Repeated rows are judged alike. There is no shuffle, no user function, and
each text is measured alone in time that grows with ``n log n`` of its length.
"""
from typing import NamedTuple

from pyspark.sql import functions as F

from postlens.llm.common import SPACE, WORD, fresh, let, whole_text

WINDOW = 5

# Frequent function words of the corpus languages.
STOP_WORDS = ("the and of to in is that a on are was for with be "
              "le la les de des et un une que en est dans pour "
              "el los las y por con una se del al como su "
              "der die das und zu den von mit ist ein eine auf nicht").split()


class Rule(NamedTuple):
    """``low <= 100 * (measure + slack) / per <= high``; a bound of None is open, ``per`` None compares the measure itself."""
    name: str
    measure: str
    per: str | None
    low: int | None
    high: int | None
    base: bool = False
    slack: int = 0


RULES = (
    Rule("few_words", "n_words", None, 10, None, True),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 20, True),
    Rule("word_length", "word_chars", "n_words", 200, 2000),
    Rule("symbols", "n_symbols", "n_words", None, 30),
    Rule("stop_words", "n_stop_words", "n_words", 2, None, slack=1),     # so texts of up to 50 words need none
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 50),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 90),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 30),
    Rule("letterless_words", "n_letterless", "n_words", None, 40),
)


def repeated_words(words):
    """Words inside windows of five words that occur at least twice in the text."""
    def windows(hashes):
        return F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW),
                           lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))

    def covered(starts):
        return F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")), lambda acc, s: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), s - acc["last"])).alias("n"), s.alias("last")))["n"]

    def places(found):
        """Starts of windows whose neighbour in the order by hash is equal."""
        ordered = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(ordered, lambda o: F.sort_array(F.transform(
            F.filter(o, lambda p, k: F.coalesce(F.get(o, k - 1)["h"] == p["h"], F.lit(False))
                     | F.coalesce(F.get(o, k + 1)["h"] == p["h"], F.lit(False))), lambda p: p["i"])))

    def count(found):
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(covered(places(found)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < WINDOW, 0).otherwise(let(hashes, lambda h: let(windows(h), count)))


def measures(text, stop_words=STOP_WORDS):
    """Struct of all measures of a text column."""
    def of_words(words):
        return F.struct(
            F.size(words).alias("n_words"), repeated_words(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(*stop_words))).alias("n_stop_words"),
            F.size(F.filter(words, lambda w: ~w.rlike(r"\p{L}"))).alias("n_letterless"))

    def of_lines(lines):
        return F.struct(
            F.size(lines).alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
            F.size(F.filter(lines, lambda x: x.rlike(rf"^{SPACE}*(?:[-*•]|[0-9]+[.)]){SPACE}"))).alias("n_bullet_lines"),
            F.size(F.filter(lines, lambda x: x.rlike(rf"(?:\.\.\.|…){SPACE}*$"))).alias("n_ellipsis_lines"))

    words = let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of_words)
    lines = let(F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)), of_lines)
    return words, lines, F.struct(
        F.length(F.regexp_replace(text, f"{SPACE}+", "")).alias("word_chars"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).alias("n_symbols"))


def judge(docs, rules=RULES, stop_words=STOP_WORDS, name="quality", columns=None):
    """``columns`` (all) of ``docs`` and a struct of all measures, ``broken`` (rule names), ``base_failed`` and ``kept``.

    A column that has the struct's ``name`` already is replaced; other columns stay. An empty table gives no rows.
    """
    columns = [c for c in columns or docs.columns if c != name]
    parts = measures(whole_text(), stop_words)
    names = [fresh(docs, f"part{i}") for i in range(len(parts))]
    # A generator, so that a filter on the verdict reads these columns; pushed below a projection it would measure the text
    # again for every rule. The outer form: the inner one would measure it once more to see whether there is a row.
    measured = F.inline_outer(F.array(F.struct(*[p.alias(n) for p, n in zip(parts, names, strict=True)])))
    wide = docs.select(*columns, measured)
    flat = {f: F.col(n)[f].cast("long") for n in names for f in wide.schema[n].dataType.names}

    def breaks(rule):
        value = (flat[rule.measure] + rule.slack) * (100 if rule.per else 1)
        unit = flat[rule.per] if rule.per else F.lit(1)
        low = F.lit(False) if rule.low is None else value < unit * rule.low
        return low if rule.high is None else low | (value > unit * rule.high)

    def some(chosen):
        return F.exists(F.array(F.lit(False), *[breaks(r) for r in chosen]), lambda x: x)

    return wide.select(*columns, F.struct(
        *[c.alias(f) for f, c in flat.items()],
        F.array_compact(F.array(*[F.when(breaks(r), F.lit(r.name)) for r in rules])).alias("broken"),
        some([r for r in rules if r.base]).alias("base_failed"), (~some(rules)).alias("kept")).alias(name))


def keep_good(docs, rules=RULES):
    """The documents that break no rule, with their own columns."""
    name = fresh(docs, "quality")
    return judge(docs, rules, name=name).where(F.col(name)["kept"]).drop(name)
