"""DuckDB's SQL for the queries of `catalog`, over the derived views."""

from __future__ import annotations

from methylspark.derived import oracle
from methylspark.functions.chemistry import Assay
from methylspark.operators.barcodes import INSERT_LEFT, LINKER, REASONS
from methylspark.operators.saturation import FRACTIONS

PAIRED = "flag IN (83, 99, 147, 163)"
#: Reference bases and their sites; records' aligned bases, by hand for the four CIGARs that the derived reads have.
SITES = """
ref_bases AS (SELECT contig, block_start + i AS pos, substr(seq, CAST(i AS INTEGER) + 1, 1) AS b FROM (SELECT *, unnest(range(0, 32)) AS i FROM ref_blocks)),
around AS (SELECT *, lag(b) OVER (PARTITION BY contig ORDER BY pos) AS p, lead(b) OVER (PARTITION BY contig ORDER BY pos) AS n FROM ref_bases),
sites AS (SELECT contig, CAST(pos AS INTEGER) AS pos,
  CASE WHEN b = 'C' THEN concat('C', n) ELSE concat('C', translate(p, 'AGT', 'TCA')) END AS context, CASE WHEN b = 'C' THEN '+' ELSE '-' END AS strand
  FROM around WHERE (b = 'C' AND n IS NOT NULL) OR (b = 'G' AND p IN ('A', 'G', 'T')))
"""
BASES = """
offsets AS (SELECT *, CAST(unnest(range(0, 25)) AS INTEGER) AS qpos FROM reads),
bases AS (SELECT *, 25 AS len, CAST(pos + CASE cigar WHEN '5S20M' THEN qpos - 5 WHEN '10M2D15M' THEN qpos + CASE WHEN qpos >= 10 THEN 2 ELSE 0 END
    WHEN '12M3I10M' THEN qpos - CASE WHEN qpos >= 15 THEN 3 ELSE 0 END ELSE qpos END AS INTEGER) AS rpos,
  substr(seq, qpos + 1, 1) AS base, nullif(substr(seq, qpos + 2, 1), '') AS next_base, qual[qpos + 1] AS q, qual[qpos + 2] AS next_q,
  CASE WHEN (flag & 16) = 0 THEN substr(seq, qpos + 1, 1) ELSE translate(substr(seq, qpos + 1, 1), 'ACGT', 'TGCA') END AS fwd,
  CASE WHEN (flag & 16) = 0 THEN nullif(substr(seq, qpos + 2, 1), '') WHEN qpos > 0 THEN translate(substr(seq, qpos, 1), 'ACGT', 'TGCA') END AS fwd_next
  FROM offsets WHERE NOT (cigar = '5S20M' AND qpos < 5) AND NOT (cigar = '12M3I10M' AND qpos BETWEEN 12 AND 14))
"""
#: Bases of callable records, with what both mates of a pair cover counted once: of two, the better (the earlier, if equal) has the sum of both qualities where they agree and four fifths of its own where not, and the other none.
BASES += f""",
resolved AS (SELECT * REPLACE (CAST(CASE WHEN n <> 2 THEN q WHEN k > 1 THEN 0 WHEN lo = hi THEN least(total, 200) ELSE floor(q * 0.8::DOUBLE) END AS INTEGER) AS q) FROM (SELECT *, count(*) OVER w AS n, row_number() OVER (w ORDER BY q DESC, ordinal) AS k, min(base) OVER w AS lo, max(base) OVER w AS hi, sum(q) OVER w AS total
  FROM bases WHERE {PAIRED} AND mapq >= 10 WINDOW w AS (PARTITION BY qname, rname, rpos)))
"""
SPOTS = """
manifest AS (SELECT concat(a.barcode_index, '_', b.barcode_index) AS spot_id, a.ord AS x, b.ord AS y, a.barcode_index AS barcode1_index, b.barcode_index AS barcode2_index,
  a.seq AS barcode1, b.seq AS barcode2, concat(a.seq, '+', b.seq) AS raw_cb FROM whitelist a CROSS JOIN whitelist b),
spots AS (SELECT raw_cb AS cb, spot_id FROM manifest UNION SELECT replace(raw_cb, '+', ''), spot_id FROM manifest)
"""


def trimmed(qpos: str, trims: dict[str, tuple[int, int]]) -> str:
    (l1, r1), (l2, r2) = trims["R1"], trims["R2"]
    left, right = (f"CASE WHEN (flag & 64) > 0 THEN {a} WHEN (flag & 128) > 0 THEN {b} ELSE 0 END" for a, b in ((l1, l2), (r1, r2)))
    start, end = f"CASE WHEN (flag & 16) > 0 THEN len - ({qpos}) ELSE {qpos} + 1 END", f"CASE WHEN (flag & 16) > 0 THEN {qpos} + 1 ELSE len - ({qpos}) END"
    return f"((({left}) > 0 OR ({right}) > 0) AND (({start}) <= ({left}) OR ({end}) <= ({right})))"


def cg_calls(assay: Assay, trims: dict, by_spot: bool, name: str) -> str:
    """Two CTEs that end in `name`."""
    meth, unmeth = ("('TG', 'CA')", "('CG')") if assay.converts_methylated else ("('CG')", "('TG', 'CA')")
    key, join, where = ("spot_id, ", "JOIN spots s ON s.cb = upper(bases.cb)", "") if by_spot else ("", "", "")
    return f"""
{name}_pairs AS (SELECT {key}rname, rpos AS pos, concat(base, next_base) AS pair FROM resolved bases JOIN sites ON sites.contig = rname AND sites.pos = rpos AND context = 'CG' {join}
  WHERE q >= 30 AND next_base IS NOT NULL AND NOT {trimmed("qpos", trims)} AND NOT {trimmed("qpos + 1", trims)} {where}),
{name} AS (SELECT {key}rname, pos, count(*) FILTER (pair IN {meth}) AS meth, count(*) FILTER (pair IN {unmeth}) AS unmeth,
  round_even(count(*) FILTER (pair IN {meth}) / count(*) * 100, 2) AS pct FROM {name}_pairs WHERE pair IN ('TG', 'CA', 'CG') GROUP BY ALL)"""


def ch_calls(assay: Assay, trims: dict, by_spot: bool, name: str) -> str:
    kept = "((strand = '+' AND fwd = 'C') OR (strand = '-' AND fwd = 'G'))"
    meth = f"NOT {kept}" if assay.converts_methylated else kept
    key, join = ("spot_id, ", "JOIN spots s ON s.cb = upper(bases.cb)") if by_spot else ("", "")
    return f"""
{name}_seen AS (SELECT {key}rname, rpos AS pos, context, strand, {meth} AS m FROM resolved bases JOIN sites ON sites.contig = rname AND sites.pos = rpos AND context <> 'CG' {join}
  WHERE q >= 30 AND NOT {trimmed("qpos", trims)} AND CASE WHEN strand = '+' THEN fwd IN ('C', 'T') AND fwd_next = substr(context, 2, 1) ELSE fwd IN ('G', 'A') END),
{name} AS (SELECT {key}rname, pos, context, strand, count(*) FILTER (m) AS meth, count(*) FILTER (NOT m) AS unmeth, round_even(count(*) FILTER (m) / count(*) * 100, 2) AS pct FROM {name}_seen GROUP BY ALL)"""


def query(*parts: str) -> str:
    """CTE lists, then a SELECT."""
    return oracle(", ".join(p.strip() for p in parts[:-1]) + " " + parts[-1].strip()) if len(parts) > 1 else oracle(parts[0].strip())


MAPPED = "(flag & 4) = 0 AND mapq >= 10 AND coalesce(try_cast(nh AS INTEGER), 1) <= 1"
READS_PER_SPOT = "spot_reads AS (SELECT spot_id, count(*) AS reads FROM reads JOIN spots ON spots.cb = upper(reads.cb) GROUP BY spot_id)"


def stats(calls: str, name: str, where: str = "true") -> str:
    return f"{name} AS (SELECT spot_id, round_even(sum(CAST(round_even(pct * 100, 0) AS BIGINT)) / 100 / count(*), 6) AS mean, count(*) AS sites FROM {calls} WHERE {where} GROUP BY spot_id)"


HISTOGRAM = "histogram AS (SELECT spot_id, meth + unmeth AS depth, count(*) AS sites FROM cg WHERE meth + unmeth > 0 AND spot_id IN (SELECT spot_id FROM good) GROUP BY ALL)"
EXPECTED = f"expected AS (SELECT spot_id, f AS fraction, sum(sites * (1 - power(1 - f, depth))) AS expected FROM histogram CROSS JOIN (SELECT unnest([{', '.join(map(str, FRACTIONS))}]::DOUBLE[]) AS f) GROUP BY ALL)"
CURVE = "curve AS (SELECT fraction, quantile_cont(expected, 0.5) AS median, quantile_cont(expected, 0.25) AS q1, quantile_cont(expected, 0.75) AS q3 FROM expected GROUP BY fraction)"
LINEAR = "linear AS (SELECT slope, CASE WHEN total > 0 THEN 1 - rest / total WHEN rest <= 0 THEN 1.0 ELSE 0.0 END AS r2 FROM (SELECT any_value(slope) AS slope, sum(power(median - mean, 2)) AS total, sum(power(median - slope * fraction, 2)) AS rest FROM curve, (SELECT sum(fraction * median) / sum(fraction * fraction) AS slope, avg(median) AS mean FROM curve)))"


def searched(name: str, before: str, low: str, high: str, count: int) -> str:
    return f"""
{name}_grid AS (SELECT maximum, rate, error, i, power(10.0, ({low}) + (({high}) - ({low})) / {count - 1} * i) AS t FROM {before}, (SELECT unnest(range(0, {count})) AS i)),
{name}_top AS (SELECT maximum, rate, error, i, t, greatest(0.0, sum(median * (1 - exp(-t * fraction))) / sum(power(1 - exp(-t * fraction), 2))) AS top FROM {name}_grid, curve GROUP BY ALL),
{name}_error AS (SELECT maximum, rate, error, i, t, top, sum(power(median - top * (1 - exp(-t * fraction)), 2)) AS e FROM {name}_top, curve GROUP BY ALL),
{name} AS (SELECT CASE WHEN e < error THEN top ELSE maximum END AS maximum, CASE WHEN e < error THEN t ELSE rate END AS rate, least(e, error) AS error FROM {name}_error ORDER BY e, i LIMIT 1)"""


FIT = ", ".join(["start AS (SELECT 0.0::DOUBLE AS maximum, 1.0::DOUBLE AS rate, 'inf'::DOUBLE AS error)", searched("fit0", "start", "-4.0::DOUBLE", "2.0::DOUBLE", 800).strip(), *(searched(f"fit{k}", f"fit{k - 1}", "log10(rate) - 0.7", "log10(rate) + 0.7", 240).strip() for k in (1, 2, 3))])


def near_sql(name: str, source: str, pattern: str) -> str:
    """CTEs that end in `name` (ordinal, place): where a pattern stands in `w` of a source, exactly at one place or, nowhere exactly, within one edit. All parts of `w` are compared; the first is the longest of those that begin first, and none may follow it."""
    n = len(pattern)
    return f"""
{name}_exact AS (SELECT ordinal, w, list_filter(range(0, greatest(length(w) - {n - 1}, 0)), lambda i: substr(w, CAST(i AS INTEGER) + 1, {n}) = '{pattern}') AS l FROM {source}),
{name}_tries AS (SELECT ordinal, a, n FROM (SELECT ordinal, w, CAST(unnest(range(0, length(w))) AS INTEGER) AS a FROM {name}_exact WHERE len(l) = 0), (SELECT unnest([{n - 1}, {n}, {n + 1}]) AS n) WHERE a + n <= length(w) AND levenshtein(substr(w, a + 1, n), '{pattern}') = 1),
{name}_first AS (SELECT ordinal, a, n FROM (SELECT *, row_number() OVER (PARTITION BY ordinal ORDER BY a, n DESC) AS k FROM {name}_tries) WHERE k = 1),
{name} AS (SELECT ordinal, l[1] AS place FROM {name}_exact WHERE len(l) = 1 UNION ALL SELECT ordinal, a FROM {name}_first f WHERE NOT EXISTS (SELECT 1 FROM {name}_tries t WHERE t.ordinal = f.ordinal AND t.a >= f.a + f.n))"""


def nearest_part_sql(name: str, source: str, pattern: str, most: int) -> str:
    """CTEs that end in `name` (ordinal, place, edits): where a pattern stands in `w` of a source, exactly at one place or, nowhere exactly, with the fewest edits up to `most`. All parts of `w` are compared; the first is the longest of those that begin first, and none may follow it."""
    n = len(pattern)
    return f"""
{name}_exact AS (SELECT ordinal, w, list_filter(range(0, greatest(length(w) - {n - 1}, 0)), lambda i: substr(w, CAST(i AS INTEGER) + 1, {n}) = '{pattern}') AS l FROM {source}),
{name}_tries AS (SELECT ordinal, a, n, levenshtein(substr(w, a + 1, n), '{pattern}') AS edits FROM (SELECT ordinal, w, CAST(unnest(range(0, length(w))) AS INTEGER) AS a FROM {name}_exact WHERE len(l) = 0), (SELECT CAST(unnest(range({n - most}, {n + most + 1})) AS INTEGER) AS n) WHERE a + n <= length(w)),
{name}_best AS (SELECT ordinal, a, n, edits FROM (SELECT *, min(edits) OVER (PARTITION BY ordinal) AS least FROM {name}_tries WHERE edits <= {most}) WHERE edits = least),
{name}_first AS (SELECT ordinal, a, n, edits FROM (SELECT *, row_number() OVER (PARTITION BY ordinal ORDER BY a, n DESC) AS k FROM {name}_best) WHERE k = 1),
{name} AS (SELECT ordinal, l[1] AS place, 0 AS edits FROM {name}_exact WHERE len(l) = 1 UNION ALL SELECT ordinal, a, edits FROM {name}_first f WHERE NOT EXISTS (SELECT 1 FROM {name}_best t WHERE t.ordinal = f.ordinal AND t.a >= f.a + f.n))"""


def c_t_sql(name: str, source: str, pattern: str, most: int = 1) -> str:
    """The same for a C/T-aware pattern: the one place with the fewest mismatches of all."""
    n = len(pattern)
    cost = f"list_sum(list_transform(range(1, {n + 1}), lambda k: CASE WHEN substr('{pattern}', CAST(k AS INTEGER), 1) = 'C' THEN CASE WHEN substr(v, CAST(k AS INTEGER), 1) IN ('C', 'T') THEN 0 ELSE 1000 END WHEN substr('{pattern}', CAST(k AS INTEGER), 1) <> substr(v, CAST(k AS INTEGER), 1) THEN 1 ELSE 0 END))"
    return f"""
{name}_costs AS (SELECT ordinal, a, {cost} AS cost FROM (SELECT ordinal, a, substr(w, a + 1, {n}) AS v FROM (SELECT ordinal, w, CAST(unnest(range(0, greatest(length(w) - {n - 1}, 0))) AS INTEGER) AS a FROM {source}))),
{name}_least AS (SELECT ordinal, min(cost) AS cost FROM {name}_costs WHERE cost <= {most} GROUP BY ordinal),
{name} AS (SELECT ordinal, min(a) AS place FROM {name}_costs JOIN {name}_least USING (ordinal, cost) GROUP BY ordinal HAVING count(*) = 1)"""


def placed_sql(assay: Assay) -> str:
    """CTEs that end in `placed`: pairs with linker_at, insert_at, observed1 and observed2."""
    linker = (near_sql if assay.value.startswith("taps") else c_t_sql)("linker_found", "linker_windows", LINKER)
    if assay == Assay.TAPS:
        insert = near_sql("insert_found", "(SELECT ordinal, substr(s1, CAST(linker_at AS INTEGER) + 58, 40) AS w FROM fitting)", INSERT_LEFT[-15:])
    else:
        insert = c_t_sql("insert_found", "(SELECT ordinal, substr(s1, CAST(linker_at AS INTEGER) + 39, 74) AS w FROM fitting)", INSERT_LEFT)
    return f"""
linker_windows AS (SELECT ordinal, substr(s1, 1, 100) AS w FROM pairs),{linker},
fitting AS (SELECT ordinal, s1, place AS linker_at FROM pairs JOIN linker_found USING (ordinal) WHERE place >= 8 AND place + 38 <= length(s1)),{insert},
whole_inserts AS (SELECT ordinal, linker_at + 38 + place AS insert_at FROM fitting JOIN insert_found USING (ordinal) WHERE linker_at + 38 + place + 34 <= length(s1)),
placed AS (SELECT p.*, l.place AS linker_at, insert_at, CASE WHEN f.ordinal IS NOT NULL THEN substr(p.s1, CAST(f.linker_at AS INTEGER) - 7, 8) END AS observed2, CASE WHEN f.ordinal IS NOT NULL THEN substr(p.s1, CAST(f.linker_at AS INTEGER) + 31, 8) END AS observed1
  FROM pairs p LEFT JOIN linker_found l USING (ordinal) LEFT JOIN fitting f USING (ordinal) LEFT JOIN whole_inserts USING (ordinal))
"""


def nearest_sql(converted: bool = False) -> str:
    seq = "translate(seq, 'C', 'T')" if converted else "seq"
    return f"""
names AS (SELECT DISTINCT {seq} AS seq FROM whitelist),
variants AS (SELECT seq AS barcode, seq AS observed, 0 AS distance FROM names UNION ALL
  SELECT seq, concat(substr(seq, 1, i - 1), b, substr(seq, i + 1)), 1 FROM names, (SELECT CAST(unnest(range(1, 9)) AS INTEGER) AS i), (SELECT unnest(['A', 'C', 'G', 'T', 'N']) AS b) WHERE substr(seq, i, 1) <> b),
best AS (SELECT observed, min(distance) AS distance, arg_min(barcode, distance) AS barcode, count(*) FILTER (distance = 1) AS ones FROM variants GROUP BY observed),
known AS (SELECT observed, barcode, distance FROM best WHERE distance = 0 OR ones = 1)
"""


NEAREST, PLACED = nearest_sql(), placed_sql(Assay.TAPS)
REJECTED = f"""
judged AS (SELECT p.*, k1.barcode AS barcode1, k2.barcode AS barcode2, CASE WHEN length(s1) < 80 OR length(q1) < 80 THEN ['short_r1'] WHEN linker_at IS NULL THEN ['structure_mismatch', 'linker2_not_found']
  WHEN observed1 IS NULL THEN ['structure_mismatch'] WHEN insert_at IS NULL THEN ['structure_mismatch', 'tn5_not_found'] WHEN k1.barcode IS NULL THEN ['{REASONS[4]}'] WHEN k2.barcode IS NULL THEN ['{REASONS[5]}'] ELSE [] END AS reasons
  FROM placed p LEFT JOIN known k1 ON k1.observed = observed1 LEFT JOIN known k2 ON k2.observed = observed2)
"""
