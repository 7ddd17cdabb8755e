"""License detection by ordered signature rules.

Words are runs of ``[0-9a-z]`` and non-ASCII characters after lower-casing A-Z. A text is looked at only if it holds one of a
few keywords. Around each keyword a window is cut out that holds the longest span any rule of that keyword can take (``reach``),
and the rules of that keyword (of ``license`` also for ``licence``, and so on) whose hint word is in the window try their expression
there. A hit is an interval of words; one that lies inside an
interval of the same or a higher priority is suppressed (of equal intervals the earlier rule stays). Base phrases
(``<name> license``) are counted at every place before suppression.

Null and empty texts have no words and no hits; all other columns are ignored, repeated rows are scanned alike. Whole
texts are scanned: the cost per keyword does not depend on the length of the text. Only intervals are shuffled.
"""
import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from postlens.llm.common import let, whole_text

AT = "\x01"
CASES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOW_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEYWORDS = ("license", "licence", "licensed", "licenced", "licenses", "licences", "spdx", "copyright", "copyleft", "gpl", "lgpl", "agpl", "redistribution",
            "granted", "warranty")
# Spellings that try the rules of another keyword; whether an expression takes them is up to the expression.
SPELLINGS = {"licence": "license", "licenced": "licensed", "licences": "licenses"}
GATE = "(?i)licen[cs]e|spdx|copy(?:right|left)|gpl|redistribution|granted|warranty"

BASE = {"mit": "mit", "apache": "apache", "gpl": "general public"}

# Families: label, names (words, alternatives parted by |), versions.
FAMILIES = """
mit; mit|expat; 0
apache; apache|apache software foundation|asl; 1 0,1 1,2 0
gpl; gnu general public|general public|gnu gpl|gpl; 1,2,3
lgpl; gnu lesser general public|lesser general public|library general public|gnu lgpl|lgpl; 2,2 1,3
agpl; gnu affero general public|affero general public|gnu agpl|agpl; 1,3
gfdl; gnu free documentation|free documentation|gfdl; 1 1,1 2,1 3
bsd-2-clause; bsd 2 clause|2 clause bsd|simplified bsd|freebsd; 0
bsd-3-clause; bsd 3 clause|3 clause bsd|new bsd|modified bsd; 0
bsd-4-clause; bsd 4 clause|4 clause bsd|original bsd; 0
bsd; bsd; 0
isc; isc|internet systems consortium; 0
mpl; mozilla public|mpl; 1 0,1 1,2 0
epl; eclipse public|epl; 1 0,2 0
cddl; common development and distribution|cddl; 1 0,1 1
cpl; common public|cpl; 1 0
ipl; ibm public; 1 0
eupl; european union public|eupl; 1 1,1 2
cc0; cc0|creative commons zero|cc zero; 1 0
cc-by; cc by|creative commons attribution; 2 0,2 5,3 0,4 0
cc-by-sa; cc by sa|creative commons attribution sharealike|creative commons attribution share alike; 2 0,2 5,3 0,4 0
cc-by-nc; cc by nc|creative commons attribution noncommercial|creative commons attribution non commercial; 2 0,2 5,3 0,4 0
cc-by-nd; cc by nd|creative commons attribution noderivatives|creative commons attribution noderivs; 2 0,2 5,3 0,4 0
cc-by-nc-sa; cc by nc sa|creative commons attribution noncommercial sharealike; 2 0,2 5,3 0,4 0
cc-by-nc-nd; cc by nc nd|creative commons attribution noncommercial noderivatives; 2 0,2 5,3 0,4 0
artistic; artistic|perl artistic; 1 0,2 0
bsl; boost software|boost; 1 0
busl; business source|busl; 1 1
sspl; server side public|sspl; 1
elastic; elastic; 2 0
zlib; zlib|zlib libpng; 0
libpng; libpng; 2 0
unlicense; unlicense; 0
wtfpl; wtfpl|do what the fuck you want to public; 2
ofl; sil open font|open font|ofl; 1 0,1 1
python; python software foundation|psf|python; 2 0
postgresql; postgresql; 0
openssl; openssl; 0
php; php; 3 0,3 01
ruby; ruby; 0
ncsa; university of illinois ncsa open source|ncsa; 0
ms-pl; microsoft public|ms pl; 0
ms-rl; microsoft reciprocal|ms rl; 0
osl; open software|osl; 1 0,2 1,3 0
afl; academic free|afl; 2 1,3 0
qpl; q public|qpl; 1 0
zpl; zope public|zpl; 2 0,2 1
upl; universal permissive|upl; 1 0
vim; vim; 0
x11; x11|x consortium; 0
w3c; w3c software|w3c; 0
odbl; open database|odbl; 1 0
odc-by; open data commons attribution|odc by; 1 0
pddl; public domain dedication and|pddl; 1 0
curl; curl; 0
beerware; beerware|beer ware; 42
ftl; freetype project|freetype; 0
naist; naist; 2003
cecill; cecill; 1 0,2 0,2 1
mulan; mulan permissive software|mulan psl; 1,2
blueoak; blue oak model; 1 0 0
"""

# Texts that state a license or its absence without a name: label, keyword, words before, words after.
NOTICES = (
    ("mit", "granted", " permission is hereby ", "(?= free of charge to any person)"),
    ("isc", "granted", "(?: permission to use copy modify and or distribute(?: [^ ]+){0,32}) (?:is )?(?:hereby )?", "(?= provided)"),
    ("bsd", "redistribution", " ", "(?= and use in source and binary forms)"),
    ("no-warranty", "warranty", " without (?:any )?", "(?= )"),
    ("all-rights-reserved", "copyright", " ", "(?= (?:[^ ]+ ){0,8}all rights reserved )"),
    ("copyright", "copyright", " ", "(?= (?:c )?(?:19|20)[0-9]{2} )"),
    ("copyleft", "copyleft", " ", "(?= )"),
    ("no-license", "license", " no ", "(?= )"),
    ("proprietary", "license", " (?:proprietary|commercial|end user) ", "(?= )"),
    ("free-license", "licenses", " (?:free|open source|permissive) ", "(?= )"),
)


def rules():
    """The rules in order: id, label, keyword, hint word (or null), expression, priority, words of a base phrase (or 0)."""
    made = [("base", label, "license", words.split()[-1], f" {words} {AT}license(?= )", 3, len(words.split()))
            for label, words in BASE.items()]
    for line in FAMILIES.strip().splitlines():
        label, names, versions = (x.strip() for x in line.split(";"))
        names, versions = names.split("|"), [v for v in versions.split(",") if v != "0"]

        hints = sorted({n.split()[-1] for n in names})
        for hint in hints:
            own = "(?:" + "|".join(n for n in names if n.split()[-1] == hint) + ")"
            for v in versions:
                full = f"{label}-{v.replace(' ', '.')}"
                tail = rf" (?:(?:version|v) )?(?:v)?{v}(?= )"
                made += [
                    ("spdx", full, "spdx", hint, rf" {AT}spdx licen[cs]e identifier {own}{tail}", 6, 0),
                    ("licensed", full, "licensed", hint, rf" {AT}licen[cs]ed under (?:the )?(?:terms of the )?{own}(?: licen[cs]e)?{tail}", 5, 0),
                    ("named", full, "license", hint, rf" {own} {AT}licen[cs]e{tail}", 5, 0),
                    ("before", full, "license", hint, rf" {own}{tail} {AT}licen[cs]e(?= )", 5, 0)]
            made += [
                ("spdx", label, "spdx", hint, rf" {AT}spdx licen[cs]e identifier {own}(?= )", 4, 0),
                ("licensed", label, "licensed", hint, rf" {AT}licen[cs]ed under (?:the )?(?:terms of the )?{own}(?: licen[cs]e)?(?= )", 3, 0),
                ("named", label, "license", hint, rf" {own} {AT}licen[cs]e(?= )", 2, 0),
                ("after", label, "license", hint, rf" {AT}licen[cs]e (?:type |name )?{own}(?= )", 1, 0)]
            for word in {"gpl", "lgpl", "agpl"} & {hint}:
                made += [("word", f"{label}-{v}", word, word, rf" (?:gnu )?{AT}{word} (?:version |v)?{v}(?= )", 2, 0)
                         for v in versions] + [("word", label, word, word, rf" {AT}{word}(?= )", 1, 0)]
    made += [("notice", label, key, None, f"{before}{AT}{key.replace('licens', 'licen[cs]')}{after}", 1, 0)
             for label, key, before, after in NOTICES]
    return [dict(zip(("rule", "label", "keyword", "hint", "pattern", "priority", "base"), (f"{i:04d}-{r[0]}", *r[1:]), strict=True))
            for i, r in enumerate(made)]


RULE_TYPE = "array<struct<rule string, label string, keyword string, hint string, pattern string, priority int, base int>>"


def most_words(pattern):
    """The most words that one side of a rule's expression can span beside the keyword: its spaces, the outer one included."""
    def branch(i):
        # Spaces of the longest alternative from i on, and the place where it ends.
        best = spaces = 0
        while i < len(pattern) and pattern[i] != ")":
            c, taken = pattern[i], 0
            if c == "(":
                taken, i = branch(i + (3 if pattern[i + 1] == "?" else 1))
            elif c == "[":
                i = pattern.index("]", i)
            elif c == "|":
                best, spaces = max(best, spaces), 0
            elif c in "\\*.":
                raise ValueError(f"no bound on the words of {pattern!r}")
            else:
                taken = int(c == " ")
            i += 1
            if pattern[i:i + 1] == "{":
                end = pattern.index("}", i)
                taken, i = taken * int(pattern[i + 1:end].split(",")[-1]), end + 1
            elif pattern[i:i + 1] in ("?", "+"):
                if taken and pattern[i] == "+":
                    raise ValueError(f"no bound on the words of {pattern!r}")
                i += 1
            spaces += taken
        return max(best, spaces), i
    return branch(0)[0]


def reach():
    """Words that the rules of each keyword can need before and after it."""
    found = {k: (0, 0) for k in KEYWORDS}
    for r in rules():
        found[r["keyword"]] = tuple(map(max, found[r["keyword"]], map(most_words, r["pattern"].split(AT))))
    return found | {k: found[v] for k, v in SPELLINGS.items()}


def words_of(text):
    """The lower-case words of texts that hold a keyword, else null."""
    return F.when(text.rlike(GATE), F.regexp_extract_all(F.translate(text, *CASES), F.lit(LOW_WORD), F.lit(0)))


def windows(words):
    """Array of (place, keyword, window): the keyword with the words around it, single spaces between and at both ends."""
    sides = reach()
    before, after = (F.create_map(*[F.lit(x) for k, v in sides.items() for x in (k, v[n])]) for n in (0, 1))

    def around(i, w):
        left = F.slice(words, F.greatest(i - before[w], F.lit(0)) + 1, F.least(i, before[w]))
        right = F.slice(words, i + 2, after[w])
        return F.struct(i.cast("long").alias("place"), w.alias("keyword"), F.concat(
            F.lit(" "), F.array_join(F.concat(left, F.array(F.concat(F.lit(AT), w)), right), " "), F.lit(" ")).alias("window"))
    return F.filter(F.transform(words, lambda w, i: F.when(w.isin(*KEYWORDS), around(i, w))), lambda x: x.isNotNull())


def hits(table, keyword, place, window):
    """Array of hits of the rules at one keyword."""
    spelled = F.coalesce(F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])[keyword], keyword)
    able = F.filter(table, lambda r: (r["keyword"] == spelled) & (
        r["hint"].isNull() | window.contains(F.concat(F.lit(" "), r["hint"], F.lit(" ")))
        | window.contains(F.concat(F.lit(AT), r["hint"], F.lit(" ")))))

    def spaces(x):
        return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))

    def hit(r):
        return let(F.regexp_substr(window, r["pattern"]), lambda found: F.when(found.isNotNull(), F.struct(
            (place + 1 - spaces(F.substring_index(found, AT, 1))).alias("start"),
            (place + 1 + spaces(F.substring_index(found, AT, -1))).alias("end"),
            r["rule"].alias("rule"), r["label"].alias("label"), r["priority"].alias("priority"), r["base"].alias("base"))))
    return F.filter(F.transform(able, hit), lambda x: x.isNotNull())


def detect(docs, name="row"):
    """One row per hit (a row of nulls for texts without): doc_id, row, n_words, start, end, rule, label, priority, base, kept."""
    text = whole_text()
    n_words = F.size(F.regexp_extract_all(text, F.lit(RAW_WORD), F.lit(0))).cast("long")
    table = F.from_json(F.lit(json.dumps(rules())), RULE_TYPE)
    seen = docs.select("doc_id", F.monotonically_increasing_id().alias(name), n_words.alias("n_words"),
                       let(words_of(text), windows).alias("windows"))
    each = seen.select("doc_id", name, "n_words", F.explode_outer("windows").alias("w"))
    found = each.select("doc_id", name, "n_words", F.explode_outer(F.when(F.col("w").isNotNull(), hits(
        table, F.col("w.keyword"), F.col("w.place"), F.col("w.window")))).alias("h")).select("doc_id", name, "n_words", "h.*")
    earlier = Window.partitionBy(name).orderBy("start", F.desc("end"), F.desc("priority"), "rule").rowsBetween(
        Window.unboundedPreceding, -1)
    # A container starts no later and ends no earlier, so it comes before: the furthest end per priority is enough.
    covered = [(F.col("priority") <= p) & (F.col("end") <= F.max(F.when(F.col("priority") >= p, F.col("end"))).over(earlier))
               for p in sorted({r["priority"] for r in rules()})]
    inside = F.lit(False)
    for p, c in zip(sorted({r["priority"] for r in rules()}), covered, strict=True):
        inside = inside | ((F.col("priority") == p) & F.coalesce(c, F.lit(False)))
    return found.withColumn("kept", F.col("rule").isNotNull() & ~inside)


def scan(docs):
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    base = F.col("base") > 0

    def joined(*columns):
        return F.array_join(F.sort_array(F.array_distinct(F.concat(*columns))), ",")

    per_row = detect(docs).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"), F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("b"), F.collect_set(F.when(F.col("kept"), F.col("label"))).alias("k"),
        F.max(F.when(F.col("kept"), F.col("priority"))).alias("p"))
    return per_row.select("doc_id", "n_words", "n_base", "first_word", "last_word", joined("b").alias("base_labels"),
                          joined("b", "k").alias("labels"), F.coalesce(F.col("p") / 6.0, F.lit(0.0)).alias("score"))
