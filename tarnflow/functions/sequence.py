"""Scalar functions over reads, as JVM-side column expressions."""

from __future__ import annotations

import functools
import operator
import re

from pyspark.sql import Column, functions as F

from tarnflow.schema import BASES, COMPLEMENT, IUPAC


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: lambdas would compute an outer expression for every element."""
    return F.transform(F.array(value), body)[0]


def words(seq: Column, k: int, step: int = 1) -> Column:
    """The upper-cased words of k letters at every ``step``; none for shorter sequences."""
    starts = F.sequence(F.lit(1), F.length(seq) - k + 1, F.lit(step))
    found = let(F.upper(seq), lambda u: F.transform(starts, lambda i: F.substr(u, i, F.lit(k))))
    return F.when(F.length(seq) >= k, found).otherwise(F.array().cast("array<string>"))


def base_at(seq: Column, pos: Column | int) -> Column:
    """The letter at a position from 0; empty beyond the end."""
    return F.substr(seq, F.lit(pos) + 1 if isinstance(pos, int) else pos + 1, F.lit(1))


def count_letter(seq: Column, letter: str) -> Column:
    """How often a letter occurs, in either case."""
    return F.length(seq) - F.length(F.replace(F.upper(seq), F.lit(letter.upper()), F.lit("")))


def mean_quality(qual: Column) -> Column:
    """Mean Phred score (offset 33); 0 for an empty string."""
    total = F.aggregate(F.split(qual, ""), F.lit(0), lambda a, c: a + F.ascii(c))
    return F.when(F.length(qual) == 0, F.lit(0.0)).otherwise(total / F.length(qual) - 33)


def complexity(seq: Column) -> Column:
    """Share of the 16 two-letter words that occur; letters beyond ACGT count too. 0 below two letters."""
    pairs = [a + b for a in BASES + "N" for b in BASES + "N"]

    def share(upper: Column) -> Column:
        usual = functools.reduce(operator.add, [F.contains(upper, F.lit(p)).cast("int") for p in pairs])  # no list of words is made
        plain = F.length(F.translate(upper, BASES + "N", "")) == 0
        return F.when(plain, usual).otherwise(F.size(F.array_distinct(words(upper, 2)))) / F.lit(16.0)

    return let(F.upper(seq), share)


def entropy(seq: Column) -> Column:
    """Shannon entropy in bits over A, C, G and T; 0 without any."""
    counts = let(F.upper(seq), lambda u: F.array(*[F.length(u) - F.length(F.replace(u, F.lit(b), F.lit(""))) for b in BASES]))
    present = F.filter(counts, lambda n: n > 0)
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    bits = lambda a: let(total(a), lambda t: F.aggregate(a, F.lit(0.0), lambda x, n: x - n / t * F.log2(n / t)))
    return let(present, lambda a: F.when(F.size(a) == 0, F.lit(0.0)).otherwise(bits(a)))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, *COMPLEMENT))


def iupac_mask(letter: Column) -> Column:
    """The letter's bases as bits; 0 for anything that is no IUPAC letter."""
    masks = F.create_map(*[F.lit(x) for pair in IUPAC.items() for x in pair])
    return F.coalesce(F.try_element_at(masks, F.upper(letter)), F.lit(0))


def iupac_regex(primer: str) -> str:
    """A pattern that matches the sequences a primer stands for."""
    letters = {m: k for k, m in IUPAC.items() if k in BASES}
    sets = {k: "".join(b for bit, b in letters.items() if bit & m) for k, m in IUPAC.items()}
    return "".join(s if len(s := sets[x]) == 1 else f"[{s}]" for x in primer.upper())


def matches_primer(primer: str, seq: str) -> bool:
    return re.match(iupac_regex(primer), seq) is not None


def position_class(frequencies: Column) -> Column:
    """C, D or V for the frequencies of A, C, G and T: one base of 0.8, two with a second of 0.1, or else."""
    order = F.sort_array(frequencies, asc=False)
    first, second = order[0], order[1]
    return F.when(first >= 0.8, "C").when((first + second >= 0.8) & (second >= 0.1), "D").otherwise("V")


def is_bimodal(frequencies: Column) -> Column:
    """Whether two bases share a position: together above 0.85, the second above 0.15, the first below 0.85."""
    order = F.sort_array(frequencies, asc=False)
    return (order[0] + order[1] > 0.85) & (order[1] > 0.15) & (order[0] < 0.85)


def top_base(frequencies: Column) -> Column:
    """The most frequent base, the first of A, C, G, T among equals."""
    return F.element_at(F.array(*map(F.lit, BASES)), F.array_position(frequencies, F.array_max(frequencies)).cast("int"))


def sample_of_path(path: Column) -> Column:
    """The sample's name in a file name: all before .fastq or .fq, without the mate's tag."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(F.regexp_replace(name, r"\.(?:fastq|fq)(?:\..*)?$", ""), r"(?:_R[12](?:_\d+)?|_[rf]?[12])$", "")


def mate_of_path(path: Column) -> Column:
    """1 or 2 by the mate's tag in the file name, null without one."""
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.(?:fastq|fq|gz).*$", "")
    tag = F.regexp_extract(name, r"_(?:R|r|f)?([12])(?:_\d+)?$", 1)
    return F.when(tag != "", tag.cast("int"))


def header_id(header: Column) -> Column:
    """The label of a record: without the leading mark, up to the first semicolon or white space."""
    return F.regexp_extract(header, r"^[@>]?([^;\s]*)", 1)


def header_size(header: Column) -> Column:
    """The abundance in ``;size=N``; 1 where it is missing."""
    found = F.regexp_extract(header, r";size=(\d+)", 1)
    return F.when(found != "", found.cast("long")).otherwise(F.lit(1).cast("long"))
