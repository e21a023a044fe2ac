"""Column expressions over DNA text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from methylspark.functions import approximate


def complement(seq: Column) -> Column:
    """The complement of each base, IUPAC codes included."""
    return F.translate(seq, "ACGTRYKMBDHVacgt", "TGCAYRMKVHDBtgca")


def sequenced(seq: Column, reverse: Column) -> Column:
    """A record's bases as the machine read them."""
    return F.when(reverse, F.reverse(complement(seq))).otherwise(seq)


def converted(seq: Column) -> Column:
    """C read as T."""
    return F.translate(seq, "C", "T")


def letters(seq: Column) -> Column:
    return F.filter(F.split(seq, ""), lambda x: x != "")


def hamming(a: Column, b: Column) -> Column:
    """Places at which two texts differ; null for unequal lengths."""
    differ = F.aggregate(F.zip_with(letters(a), letters(b), lambda x, y: (x != y).cast("int")), F.lit(0), lambda n, x: n + x)
    return F.when(F.length(a) == F.length(b), differ)


def exact_positions(text: Column, pattern: Column | str, start: Column | int, end: Column | int) -> Column:
    """0-based places of a pattern, overlapping ones too, in text[start:end]."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    start, end = (F.lit(x) if isinstance(x, int) else x for x in (start, end))
    last = F.least(F.length(text), end) - F.length(pattern)
    at = F.filter(F.sequence(start, last), lambda i: F.substr(text, i + 1, F.length(pattern)) == pattern)
    return F.when(last >= start, at).otherwise(F.array().cast("array<int>"))


def parts_of(pattern: str, count: int) -> list[tuple[int, str]]:
    """A pattern in `count` parts of about one length, with the place of each."""
    cut = [len(pattern) * k // count for k in range(count + 1)]
    return [(a, pattern[a:z]) for a, z in zip(cut, cut[1:], strict=False) if z > a]


def edited_pattern(pattern: str, edits: int) -> str:
    """A regular expression of all texts that so many edits make of a pattern; of those that begin at one place it finds the longest first."""
    if edits == 0:
        return pattern
    out = ""
    for k in reversed(range(len(pattern))):
        rest = pattern[k + 1 :]
        put_in, other, left_out = edited_pattern(pattern[k:], edits - 1), edited_pattern(rest, edits - 1), edited_pattern(rest, edits - 1)
        out = f"(?:{pattern[k]}{out}|.{put_in}|.{other}|{left_out})" if out else f"(?:.{put_in}|.{other}|{left_out})"
    return out


def near_position(window: Column, pattern: str, most: int) -> Column:
    """Where a pattern stands in a text: exactly and at one place; or nowhere exactly, but with the fewest edits that any match needs, at most `most`, and no other such match
    apart from it. Null otherwise. One edit is found by a regular expression, so that rows stay in the JVM; its text grows fast with edits, so for more a bit-parallel matcher gets
    the texts without an exact match."""
    exact = F.instr(window, pattern)
    out = F.when(exact > 0, F.when(F.instr(F.substr(window, exact + 1), pattern) == 0, exact - 1))
    if most > 1:
        return out.otherwise(approximate.place(F.when(exact == 0, window), pattern, most))
    for edits in range(1, most + 1):
        regex = F.lit(edited_pattern(pattern, edits))
        found = F.regexp_substr(window, regex)
        at = F.instr(window, found)
        out = out.when(found.isNotNull(), F.when(F.regexp_instr(F.substr(window, at + F.length(found)), regex) == 0, at - 1))
    return out


def only(found: Column) -> Column:
    """The one element of an array, or null."""
    return F.when(F.size(found) == 1, F.element_at(found, 1))


def c_t_mismatches(observed: Column, expected: Column) -> Column:
    """Places that differ, where an expected C may also be read as T; null if an expected C is neither."""
    costs = F.zip_with(letters(observed), letters(expected), lambda o, e: F.when(e == "C", F.when(o.isin("C", "T"), 0)).otherwise((o != e).cast("int")))
    bad = F.exists(costs, lambda c: c.isNull())
    return F.when((F.length(observed) == F.length(expected)) & ~bad, F.aggregate(costs, F.lit(0), lambda n, c: n + c))


def c_t_pattern(pattern: str) -> str:
    """A regular expression in which a C may also be read as T."""
    return pattern.upper().replace("C", "[CT]")


def c_t_position(window: Column, pattern: str, most: int) -> Column:
    """Where a C/T-aware pattern stands in a text with the fewest mismatches, at most `most`; null where that is not one place.

    Exact places are found by a regular expression. Without one, places are compared at which one of most + 1 parts of the pattern stands unchanged.
    """
    n = len(pattern)
    regex = F.lit(c_t_pattern(pattern))
    first = F.regexp_instr(window, regex)
    exact = F.when(F.regexp_instr(F.substr(window, first + 1), regex) == 0, first - 1)
    if most <= 0:
        return F.when(first > 0, exact)
    whole = "|".join(f"^.{{{place}}}{c_t_pattern(part)}" for place, part in parts_of(pattern, most + 1))
    starts = F.when(F.length(window) >= n, F.sequence(F.lit(0), F.length(window) - n)).otherwise(F.array().cast("array<int>"))
    likely = F.filter(starts, lambda i: F.substr(window, i + 1, F.lit(n)).rlike(whole))
    scored = F.transform(likely, lambda i: F.struct(c_t_mismatches(F.substr(window, i + 1, F.lit(n)), F.lit(pattern)).alias("cost"), i.alias("at")))
    best = F.slice(F.array_sort(F.filter(scored, lambda s: s["cost"] <= most)), F.lit(1), F.lit(2))
    # of the two best the first, if it is better
    near = F.aggregate(best, F.lit(None).cast("struct<cost:int,at:int>"), lambda one, s: F.when(one.isNull(), s).when(one["cost"] < s["cost"], one).otherwise(F.struct(one["cost"].alias("cost"), F.lit(-1).alias("at"))), lambda one: F.when(one["at"] >= 0, one["at"]))
    return F.when(first > 0, exact).otherwise(near)


def c_positions(pattern: str) -> list[int]:
    return [k for k, base in enumerate(pattern.upper()) if base == "C"]


def methylated_positions(text: str, pattern: str) -> list[int]:
    """The 0-based places that a list such as "3,6,10" names, each once; they must lie in the pattern and hold a C, and there must be one at least."""
    out: list[int] = []
    for token in filter(None, (t.strip() for t in text.split(","))):
        if not token.lstrip("+-").isdigit() or not 0 <= int(token) < len(pattern) or pattern[int(token)] != "C":
            raise ValueError(f"{token!r} is not the place of a C in {pattern}")
        if int(token) not in out:
            out.append(int(token))
    if not out:
        raise ValueError("no methylated place is named")
    return out


def annotated_header(header: Column, first: Column, second: Column) -> Column:
    """A read's header with both barcodes before its name."""
    return F.when(F.substr(header, F.lit(1), F.lit(1)) == "@", F.concat(F.lit("@"), first, F.lit("+"), second, F.lit(":"), F.substr(header, F.lit(2)))).otherwise(F.raise_error(F.lit("a FASTQ header must start with @")))


def conversion(insert: Column, positions: list[int]) -> Column:
    """The bases of an insert at the methylated positions, "." beyond its end."""
    return F.array(*(F.coalesce(F.nullif(F.substr(insert, F.lit(p + 1), F.lit(1)), F.lit("")), F.lit(".")) for p in positions))
