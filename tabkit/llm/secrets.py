"""Secret scan: patterns for known forms, and sliding-window entropy for strings that only look random.

Everything is an expression over one row, so the scan is a single pass without a shuffle and without Python on the data
path; a lost executor costs its own splits only. Cases: a NULL text counts as empty and gives no span; a very long text
is scanned whole, in steps whose cost does not grow with its length or with the number of matches; repeated
rows, NULL ids and ties each give their own row with equal spans; an empty table gives an empty result. The result holds
the id and the columns named here only, so extra input columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns. Those with a least length are written with it, which finds the same spans.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"

# Kinds in the order that settles ties of position; the base kinds come first.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_alnum", "entropy_base64", "entropy_base36", "entropy_key")
BASE = 3

# Candidate strings: maximal runs of these characters, 20 or more, with a digit and a letter.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{20,}"

# Parts of a candidate between = / _ and -, with the same least length; they are tested besides the whole run.
PART = r"(?<![A-Za-z0-9+])(?=[A-Za-z+]*[0-9])(?=[0-9+]*[A-Za-z])[A-Za-z0-9+]{20,}"

RUN = 300  # matches that are added up before they are joined to those before

# Character classes with the strings they hold, the window and the least entropy in bits of a window. Every candidate has one.
CLASSES = (
    ("entropy_hex", r"^([0-9a-f]+|[0-9A-F]+)$", 20, 3.0),
    ("entropy_alnum", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9]+$", 20, 3.6),
    ("entropy_base64", r"^(?=.*[a-z])(?=.*[A-Z])(?=.*[+/_=-]).*$", 20, 3.6),
    ("entropy_base36", r"^(?=.*[G-Zg-z])([0-9a-z]+|[0-9A-Z]+)$", 20, 3.6),
    ("entropy_key", r"^(?=.*[+/_=-])([0-9a-z+/_=-]+|[0-9A-Z+/_=-]+)$", 20, 3.8),
)
# Those that a part may have of its own; windows of the others, whose strings hold separators, are windows of the whole run too.
OF_PARTS = ("entropy_hex", "entropy_alnum", "entropy_base36")

# Strings that are random-looking but known to be harmless. A run or part that is one of them as a whole has no windows; of others
# only the windows go that hold one.
ALLOW = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUID
    r"(?i)example|placeholder|changeme|xxxxx|00000000",  # stand-ins
    r"(?i)0123456789abcdef|abcdefghijklmnop",  # counting strings
    # paths and slugs of plain words and numbers: no letter beside a digit, a separator inside. No group is repeated, since each
    # repetition of a group is a call inside the last one to the matcher
    r"^(?!.*(?:[A-Za-z][0-9]|[0-9][A-Za-z]))(?=.*[A-Za-z0-9][-_/=]+[A-Za-z0-9])/?[A-Za-z0-9][A-Za-z0-9_/=-]*$",
)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once. Spark evaluates what a lambda names from outside anew for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _located(text: Column, pattern: str) -> Column:
    """Matches with their places: array of (start, end, value), in code points, end exclusive.

    Places are running sums of the lengths of gaps and matches. Matches are added up in runs of ``RUN``, then the runs, so that
    appending to an array copies ``RUN`` elements at most.
    """
    spans = "array<struct<start:bigint,end:bigint,value:string>>"
    at = lambda n: F.lit(n).cast("bigint")

    def measured(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        return F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).cast("bigint").alias("gap"), F.length(m).cast("bigint").alias("long"), m.alias("m")))

    def in_run(run: Column) -> Column:  # places from the start of the run
        begin = F.struct(at(0).alias("at"), F.array().cast(spans).alias("out"))
        return F.aggregate(run, begin, lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["long"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["long"]).alias("end"), x["m"].alias("value")))).alias("out")))

    def moved(runs: Column) -> Column:
        begin = F.struct(at(0).alias("at"), F.array().cast("array<bigint>").alias("out"))
        bases = F.aggregate(runs, begin, lambda acc, r: F.struct((acc["at"] + r["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
        return F.flatten(F.zip_with(runs, bases, lambda r, base: F.transform(r["out"], lambda m: F.struct(
            (base + m["start"]).alias("start"), (base + m["end"]).alias("end"), m["value"].alias("value")))))

    def placed(steps: Column) -> Column:
        begins = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / RUN).cast("int"))
        return _let(F.transform(begins, lambda i: in_run(F.slice(steps, i * RUN + 1, RUN))), moved)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.rlike(pattern), _let(_let(found, measured), placed)).otherwise(F.array().cast(spans))


def random_windows(value: Column, window: int, least: float, harmless: Column | None = None) -> Column:
    """Spans of a string whose windows have at least ``least`` bits of Shannon entropy; overlapping windows are merged.
    Windows that hold a span (start, end, value) of ``harmless`` whole do not count; these spans are sorted and apart.

    One step per character: the entering character raises its count, the leaving one lowers its own, and the sum of n log2 n over the
    counts changes by those two terms only; the entropy is log2(window) - sum / window. The counts stand side by side in a few whole
    numbers and the terms in a table, as whole multiples of 2^-32, so a step costs the same in a string of any length and nothing drifts.
    """
    spans = "array<struct<start:bigint,end:bigint>>"
    bits = window.bit_length()
    per_word = 60 // bits
    words = -(-len(ALPHABET) // per_word)
    nlogn = [round(n * math.log2(n) * 2**32) if n else 0 for n in range(window + 2)]
    longs = lambda values: F.array(*[F.lit(v).cast("bigint") for v in values])
    # by code, 0 for no character
    word_of = F.array(*[F.lit(-1)], *[F.lit(k // per_word) for k in range(len(ALPHABET))])
    shift_of = F.array(*[F.lit(0)], *[F.lit(bits * (k % per_word)) for k in range(len(ALPHABET))])
    unit_of = longs([0, *[1 << bits * (k % per_word) for k in range(len(ALPHABET))]])
    raises = longs([b - a for a, b in zip(nlogn, nlogn[1:])])  # what a count of n adds when it becomes n + 1
    limit = math.floor((math.log2(window) - least + 1e-9) * window * 2**32)

    harmless = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>") if harmless is None else harmless
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    # entering and leaving code of every character, and one step more in which the last window is judged
    steps = _let(codes, lambda c: F.arrays_zip(F.concat(c, F.array(F.lit(0))).alias("e"), F.slice(F.concat(F.array_repeat(F.lit(0), window), c), 1, F.size(c) + 1).alias("l")))
    at = lambda n: F.lit(n).cast("bigint")
    begin = F.struct(*[at(0).alias(f"w{j}") for j in range(words)], at(0).alias("sum"), at(0).alias("at"), at(-1).alias("from"), at(-1).alias("upto"),
                     F.array().cast(spans).alias("out"), F.lit(0).alias("past"), at(-1).alias("held"))
    pair = lambda start, end: F.array(F.struct(start.alias("start"), end.alias("end")))

    def fold(steps: Column, harmless: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            enters, leaves = x["e"], x["l"]
            counts = F.array(*[acc[f"w{j}"] for j in range(words)])
            number = lambda code: F.call_function("shiftright", F.get(counts, F.get(word_of, code)), F.get(shift_of, code)).bitwiseAND((1 << bits) - 1).cast("int")
            added = F.when(enters > 0, F.get(raises, number(enters))).otherwise(at(0))
            taken = F.when(leaves > 0, F.get(raises, number(leaves) - 1)).otherwise(at(0))
            changed = F.when(enters == leaves, at(0)).otherwise(added - taken)
            word = lambda j: (acc[f"w{j}"] + F.when(F.get(word_of, enters) == j, F.get(unit_of, enters)).otherwise(at(0))
                              - F.when(F.get(word_of, leaves) == j, F.get(unit_of, leaves)).otherwise(at(0)))
            # the window that ended with the step before
            start = acc["at"] - window
            high = (acc["at"] >= window) & (acc["held"] < start) & (acc["sum"] <= limit)
            apart = acc["upto"] < start
            closed = high & apart & (acc["from"] >= 0)
            here = F.get(harmless, acc["past"])  # the next harmless span; ``held`` is the start of the last one passed
            ends = F.coalesce(here["end"] <= acc["at"] + 1, F.lit(False))
            return F.struct(*[word(j).alias(f"w{j}") for j in range(words)], (acc["sum"] + changed).alias("sum"), (acc["at"] + 1).alias("at"),
                            F.when(high & (apart | (acc["from"] < 0)), start).otherwise(acc["from"]).alias("from"), F.when(high, acc["at"]).otherwise(acc["upto"]).alias("upto"),
                            F.when(closed, F.concat(acc["out"], pair(acc["from"], acc["upto"]))).otherwise(acc["out"]).alias("out"),
                            (acc["past"] + ends.cast("int")).alias("past"), F.when(ends, here["start"]).otherwise(acc["held"]).alias("held"))

        return F.aggregate(steps, begin, step, lambda acc: F.when(acc["from"] >= 0, F.concat(acc["out"], pair(acc["from"], acc["upto"]))).otherwise(acc["out"]))

    return _let(harmless, lambda h: fold(steps, h))


def _ranked(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                                                 s["end"].alias("end")))


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """Columns: the id, ``base`` and ``spans``, arrays of (kind, start, end) sorted by start, then kind.

    ``spans`` holds every base span and, in addition, the high-entropy windows of candidate strings, and of their
    parts, which match no pattern of ``allow`` as a whole. Windows in which such a pattern is found are left out.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    out = df.select(F.col(f"`{id_col}`").alias("id"), text.alias("t"))
    out = out.select("id", _located(F.col("t"), ASSIGN).alias("a"), _located(F.col("t"), ACCESS).alias("k"),
                     _located(F.col("t"), HEX).alias("h"), _located(F.col("t"), CANDIDATE).alias("c"))
    long_enough = F.filter(F.col("a"), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_LEAST)
    out = out.select("id", F.concat(_ranked(long_enough, "assign"), _ranked(F.col("k"), "access"),
                                    _ranked(F.col("h"), "hex")).alias("b"), "c")
    allowed = "|".join(f"(?:{p})" for p in allow) or "(?!)"
    whole = F.lit("|".join(f"(?:^(?:{p})$)" for p in allow) or "(?!)")
    out = out.select("id", "b", F.filter(F.col("c"), lambda s: ~F.regexp_like(s["value"], whole)).alias("c"))
    parts = F.flatten(F.transform("c", lambda s: F.transform(
        F.filter(_located(s["value"], PART), lambda p: (F.length(p["value"]) < F.length(s["value"])) & ~F.regexp_like(p["value"], whole)),
        lambda p: F.struct((s["start"] + p["start"]).alias("start"), (s["start"] + p["end"]).alias("end"), p["value"].alias("value")))))
    out = out.select("id", "b", "c", F.when(F.size("c") > 0, parts).otherwise(F.slice("c", 1, 0)).alias("p"))
    spotted = lambda s: F.struct(s["start"].alias("start"), s["value"].alias("value"), _located(s["value"], allowed).alias("harmless"))
    out = out.select("id", "b", F.transform("c", spotted).alias("cs"), F.transform("p", spotted).alias("ps"))

    def windows(kind: str, belongs: str, window: int, least: float) -> Column:
        own = F.filter(F.concat("cs", "ps") if kind in OF_PARTS else F.col("cs"), lambda s: F.regexp_like(s["value"], F.lit(belongs)))
        return F.flatten(F.transform(own, lambda s: F.transform(
            random_windows(s["value"], window, least, s["harmless"]),
            lambda w: F.struct((s["start"] + w["start"]).alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                               (s["start"] + w["end"]).alias("end")))))

    more = F.when(F.size("cs") > 0, F.concat(*[windows(*c) for c in CLASSES])).otherwise(
        F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>"))
    out = out.select("id", F.array_sort("b").alias("b"), F.array_sort(F.concat("b", more)).alias("s"))
    named = lambda spans: F.transform(spans, lambda s: F.struct(
        F.element_at(F.array(*map(F.lit, KINDS)), s["rank"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return out.select(F.col("id").alias(id_col), named(F.col("b")).alias("base"), named(F.col("s")).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
