"""Secret scan: three patterns and sliding-window Shannon entropy of candidate strings. JVM-side only.

A candidate is a run of token characters. Its character class (hexadecimal or mixed) sets the window
width and the least entropy. Counts of the window's characters are kept in a string with one cell per
ASCII code; each step takes one character out or in and changes the sum of c * log2(c) by the two terms
concerned, in fixed-point whole numbers, so the result does not depend on the order of additions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tarnflow.functions.sequence import let

# The three base patterns and the least lengths of their matches.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: What every match of ASSIGN begins with; texts without it need no further look.
ASSIGN_HINT = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"  # maximal runs of 16 characters or more
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Character class: pattern of the whole candidate, window width, least bits a character.
CLASSES = {"hex": (r"^(?:[0-9a-f]+|[0-9A-F]+)$", 20, 3.0), "mixed": (r"[A-Za-z]", 24, 3.9)}
#: Candidates that are never secrets: UUIDs, words with hyphens or underscores, paths, and known stand-ins.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
    r"|^[A-Za-z]+(?:[-_/+=][A-Za-z]+)*[-_/+=]*$|^[a-z0-9]+(?:[-_][a-z]+){3,}[a-z0-9_-]*$|//"
    r"|(?i:example|placeholder|changeme|dummy|lorem|redacted)|^(.)\1+$|0123456789|(?i:abcdefghijkl)"
)
SCALE = 1 << 20


#: Matches that are gone through before their results are set aside; appending to a list copies it.
BLOCK = 256
PART = 1024  # code points of a part of a text that is masked
SPAN = "struct<start:int,end:int,rank:int,text:string>"


def _scan(cells: Column, start: Column, step, of: str) -> Column:
    """What ``step(state, cell)``, a struct of the next ``state`` and an array ``out``, gives along ``cells``, in one array.

    Blocks of cells are gone through each on its own, so that the copies made by appending stay small.
    """
    none, nones = F.array().cast(f"array<{of}>"), F.array().cast(f"array<array<{of}>>")

    def one(acc: Column, cell: Column) -> Column:
        return let(step(acc["state"], cell), lambda x: F.struct(x["state"].alias("state"), F.concat(acc["out"], x["out"]).alias("out")))

    def block(all_: Column):
        def run(acc: Column, i: Column) -> Column:
            part = F.aggregate(F.slice(all_, i, F.lit(BLOCK)), F.struct(acc["state"].alias("state"), none.alias("out")), one)
            return let(part, lambda x: F.struct(x["state"].alias("state"), F.concat(acc["out"], F.array(x["out"])).alias("out")))

        return run

    def whole(all_: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(all_), F.lit(BLOCK))
        return F.flatten(F.aggregate(starts, F.struct(start.alias("state"), nones.alias("out")), block(all_))["out"])

    return let(cells, lambda all_: F.when(F.size(all_) > 0, whole(all_)).otherwise(none))


def _spans(kind: str, text: Column, pattern: str, good=None) -> Column:
    """Array of (start, end, kind, text) of the pattern's leftmost non-overlapping matches, in code points."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(good[0])) if good else whole
    rank = ["assign", "access", "hex", "entropy"].index(kind)
    cells = let(whole, lambda m: F.arrays_zip(m.alias("m"), F.slice(between, F.lit(1), F.size(m)).alias("b"), (checked if good else m).alias("g")))

    def step(pos: Column, x: Column) -> Column:
        start = pos + F.length(x["b"])
        end = start + F.length(x["m"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"), F.lit(rank).alias("rank"), x["m"].alias("text")))
        return F.struct(end.alias("state"), (F.filter(one, lambda _: F.length(x["g"]) >= good[1]) if good else one).alias("out"))

    return _scan(cells, F.lit(0), step, SPAN)


def _high_window(text: Column, width: int, bits: float) -> Column:
    """(first, last): from the first window of at least so many bits a character to the end of the last such one."""
    table = F.array(*[F.lit(round(c * math.log2(c) * SCALE) if c else 0).cast("long") for c in range(width + 1)])
    most = round(width * math.log2(width) * SCALE)
    least = most - math.floor((math.log2(width) - bits) * width * SCALE)  # most - sum >= least
    cells = F.repeat(F.lit(chr(1)), 128)

    def over(chars: Column) -> Column:
        def step(acc: Column, k: Column) -> Column:
            i = F.floor(k / 2).cast("int")
            enters = k % 2 == 1
            at = F.when(enters, i).otherwise(i - width)

            def moved(code: Column) -> Column:
                was = F.ascii(F.substring(acc["cells"], code + 1, F.lit(1))) - 1
                now = was + F.when(enters, 1).otherwise(-1)
                total = acc["total"] + F.get(table, now) - F.get(table, was)
                high = enters & (i >= width - 1) & (F.lit(most) - total >= least)
                return F.struct(
                    F.overlay(acc["cells"], F.chr(now + 1), code + 1, F.lit(1)).alias("cells"),
                    total.alias("total"),
                    F.when(high & (acc["first"] < 0), i - width + 1).otherwise(acc["first"]).alias("first"),
                    F.when(high, i + 1).otherwise(acc["last"]).alias("last"),
                )

            return F.when(at >= 0, let(F.ascii(F.get(chars, at)), moved)).otherwise(acc)

        events = F.sequence(F.lit(0), F.size(chars) * 2 - 1)
        start = F.struct(cells.alias("cells"), F.lit(0).cast("long").alias("total"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))
        return F.aggregate(events, start, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))

    return let(F.split(text, ""), over)  # split once a candidate


def _clear_of(found: Column, base: Column) -> Column:
    """The candidates that no base span overlaps, by a pass along all of them in order and one back."""
    event = "struct<start:int,is_free:int,end:int,text:string>"

    def events(spans: Column, is_free: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(is_free).alias("is_free"), s["end"].alias("end"), s["text"].alias("text")))

    def ahead(reach: Column, e: Column) -> Column:
        base_ = e["is_free"] == 0
        state = F.when(base_, F.greatest(reach, e["end"])).otherwise(reach)
        return F.struct(state.alias("state"), F.filter(F.array(e), lambda _: base_ | (reach <= e["start"])).alias("out"))

    def back(next_: Column, e: Column) -> Column:
        base_ = e["is_free"] == 0
        state = F.when(base_, e["start"]).otherwise(next_)
        return F.struct(state.alias("state"), F.filter(F.array(e), lambda _: ~base_ & (next_ >= e["end"])).alias("out"))

    ordered = F.array_sort(F.concat(events(base, 0), events(found, 1)))
    kept = _scan(F.reverse(_scan(ordered, F.lit(0), ahead, event)), F.lit(2**31 - 1), back, event)
    return F.transform(kept, lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), F.lit(3).alias("rank"), e["text"].alias("text")))


def _entropy(found: Column, base: Column) -> Column:
    """Spans of the candidates' high windows, without allowed candidates and those that a base span covers."""
    likely = F.filter(found, lambda c: c["text"].rlike("[A-Za-z]") & c["text"].rlike("[0-9]") & ~c["text"].rlike(ALLOWED))
    free = let(likely, lambda c: F.when((F.size(base) > 0) & (F.size(c) > 0), _clear_of(c, base)).otherwise(c))

    def window(c: Column) -> Column:
        hexes, mixed = CLASSES["hex"], CLASSES["mixed"]
        of = F.when(c["text"].rlike(hexes[0]), _high_window(c["text"], *hexes[1:])).otherwise(_high_window(c["text"], *mixed[1:]))
        return F.struct(c["start"].alias("at"), of.alias("w"))

    high = F.filter(F.transform(free, window), lambda x: x["w"]["first"] >= 0)
    return F.transform(
        high,
        lambda x: F.struct((x["at"] + x["w"]["first"]).alias("start"), (x["at"] + x["w"]["last"]).alias("end"), F.lit(3).alias("rank"), F.lit("").alias("text")),
    )


def _joined(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, ("assign", "access", "hex", "entropy")))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"])))
    parts = F.transform(ordered, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def scan(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns of every row with ``n_assign``, ``n_access``, ``n_hex``, ``n_entropy``, ``base`` and ``spans``.

    ``base`` and ``spans`` list ``kind:start:end`` by start, then kind, comma-joined; offsets are code points,
    ends exclusive. ``base`` has the three patterns' spans, ``spans`` those and the entropy spans. Null and
    empty texts have no spans (empty strings). Rows are independent: repeated rows each get their result,
    an empty table an empty one. Columns not in ``keep`` are not read. One map without any shuffle. Whole texts are
    read however long they are; work grows in proportion to the text, long candidates and many matches included.
    Where spans of several kinds begin at one place, they are listed in the order of kinds.
    """
    t = F.col("__t")
    none = F.array().cast(f"array<{SPAN}>")
    lists = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__t")).select(
        *keep,
        F.when(t.rlike(ASSIGN_HINT), _spans("assign", t, ASSIGN, (2, ASSIGN_LEAST))).otherwise(none).alias("__a"),
        F.when(F.contains(t, F.lit("AKIA")), _spans("access", t, ACCESS)).otherwise(none).alias("__k"),
        F.when(t.rlike(HEX), _spans("hex", t, HEX)).otherwise(none).alias("__h"),
        F.when(t.rlike(CANDIDATE), _spans("entropy", t, CANDIDATE)).otherwise(none).alias("__c"),
    )
    based = lists.withColumn("__b", F.concat("__a", "__k", "__h"))
    added = based.withColumn("__e", F.when(F.size("__c") > 0, _entropy(F.col("__c"), F.col("__b"))).otherwise(none))
    return added.select(
        *keep,
        F.size("__a").cast("long").alias("n_assign"),
        F.size("__k").cast("long").alias("n_access"),
        F.size("__h").cast("long").alias("n_hex"),
        F.size("__e").cast("long").alias("n_entropy"),
        _joined(F.col("__b")).alias("base"),
        _joined(F.concat("__b", "__e")).alias("spans"),
    )


def masked(docs: DataFrame, text: str = "text", mask: str = "[secret]", length: str | None = None) -> DataFrame:
    """All rows and columns of ``docs``, with every span of ``scan`` in the text replaced by ``mask``.

    Overlapping spans become one mask. Texts without secrets, null and empty ones stay as they are. A column
    named by ``length`` gets the new number of code points where a text changes.
    """
    own = [c for c in docs.columns if c != text]
    renamed = docs.select(*(F.col(c).alias(f"__own{i}") for i, c in enumerate(own)), F.col(text).alias("__text"))
    found = scan(renamed, renamed.columns, "__text")
    pairs = F.transform(F.split("spans", ","), lambda s: F.transform(F.slice(F.split(s, ":"), 2, 2), lambda x: x.cast("int")))
    parts = F.regexp_extract_all("__text", F.lit(f"(?s).{{1,{PART}}}"), F.lit(0))  # no character is looked for from the text's begin

    def between(parts: Column, a: Column, b: Column) -> Column:
        within = F.sequence(F.floor(a / PART), F.floor((b - 1) / PART))
        cut = lambda i: F.substring(F.get(parts, i.cast("int")), F.greatest(a - i * PART, F.lit(0)).cast("int") + 1, F.least(b - F.greatest(a, i * PART), F.lit(PART)).cast("int"))
        return F.when(a < b, F.array_join(F.transform(within, cut), "")).otherwise("")

    def replaced(parts: Column) -> Column:
        def step(at: Column, s: Column) -> Column:
            new = F.array(F.concat(between(parts, at, s[0]), F.lit(mask)))
            return F.struct(F.greatest(at, s[1]).alias("state"), F.filter(new, lambda _: s[0] >= at).alias("out"))

        end = F.array_max(F.transform(pairs, lambda s: s[1]))
        return F.concat(F.array_join(_scan(pairs, F.lit(0), step, "string"), ""), between(parts, end, F.length("__text")))

    cut = let(parts, replaced)
    changed = F.col("spans") != ""
    new = found.withColumn("__new", F.when(changed, cut).otherwise(F.col("__text")))
    columns = {c: F.col(f"__own{i}") for i, c in enumerate(own)} | {text: F.col("__new")}
    if length:
        columns[length] = F.when(changed, F.length("__new")).otherwise(columns[length]).cast(docs.schema[length].dataType)
    return new.select(*(columns[c].alias(c) for c in docs.columns))
