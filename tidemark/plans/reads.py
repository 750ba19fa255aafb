"""Queries: read-level jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.sequences import expected_errors, reverse_complement
from tidemark.operators import reads as rd
from tidemark.operators import tags as tg
from tidemark.operators.spike_in import without_genome
from tidemark.plans.registry import query
from tidemark.plans.sources import FORWARD_PRIMER, REVERSE_PRIMER, _AMPLICON, _RCSQL
from tidemark.plans.views import VIEWS, ctes, view
from tidemark.session import spread_small_scan

FRC, RRC = "AGAGTGACGGGCGGTGT", "CATGGTAAGTGTACCGGAAG"


@query(
    "r1_reverse_complement",
    ctes("features")
    + """ SELECT asv_id, translate(reverse(upper(concat(sequence, 'rykmbvdhswn'))), 'ACGTRYKMBVDHSWN', 'TGCAYRMKVBHDSWN')
    AS rc FROM features""",
)
def _(spark, sf):
    df = view(spark, sf, "features")
    return df.select("asv_id", reverse_complement(F.concat("sequence", F.lit("rykmbvdhswn"))).alias("rc"))


def _place(reads: str, primer: str, end: str, lo: str) -> str:
    """Best placement per distinct read by Hamming distance, as SQL."""
    m = len(primer)
    if end == "front":
        over = f"{m} + least(o, 0)"
        a, b = "substr(s, greatest(o, 0) + 1, k)", f"right('{primer}', k)"
        room = f"o + {m} <= length(s)"
    else:
        over, a, b, room = f"least({m}, length(s) - o)", "substr(s, o + 1, k)", f"left('{primer}', k)", "TRUE"
    return f"""(SELECT s, first(greatest(o, 0) ORDER BY k - 2 * e DESC, o) AS start, first(least(o + {m}, length(s)) ORDER BY
    k - 2 * e DESC, o) AS stop FROM (SELECT s, o, k, hamming({a}, {b}) AS e FROM (SELECT s, o, CAST({over} AS BIGINT) AS k FROM
    {reads}, range({lo}, 80) r(o) WHERE o < length(s) AND {room}) WHERE k >= 3) WHERE e <= floor(k / 10) GROUP BY s)"""


_FRONT = ctes("pairs") + f""",
d1 AS (SELECT DISTINCT r1_seq AS s FROM pairs), d2 AS (SELECT DISTINCT r2_seq AS s FROM pairs),
f1 AS {_place('d1', FORWARD_PRIMER, 'front', '-14')}, f2 AS {_place('d2', REVERSE_PRIMER, 'front', '-17')},
cut AS (SELECT p.sample, p.read_no, substr(r1_seq, coalesce(f1.stop, 0) + 1) AS r1_seq, substr(r1_qual, coalesce(f1.stop, 0)
  + 1) AS r1_qual, substr(r2_seq, coalesce(f2.stop, 0) + 1) AS r2_seq, substr(r2_qual, coalesce(f2.stop, 0) + 1) AS r2_qual,
  f1.stop IS NULL OR f2.stop IS NULL AS untrimmed FROM pairs p LEFT JOIN f1 ON f1.s = r1_seq LEFT JOIN f2 ON f2.s = r2_seq),
trimmed AS (SELECT * EXCLUDE (untrimmed), CASE WHEN untrimmed THEN 'untrimmed' WHEN length(r1_seq) < 20 OR length(r2_seq) < 20
  THEN 'short' ELSE 'trimmed' END AS status FROM cut)"""
_BACK = _FRONT + f""",
kept AS (SELECT * FROM trimmed WHERE status = 'trimmed'),
e1 AS (SELECT DISTINCT r1_seq AS s FROM kept), e2 AS (SELECT DISTINCT r2_seq AS s FROM kept),
b1 AS {_place('e1', RRC, 'back', '0')}, b2 AS {_place('e2', FRC, 'back', '0')},
both_cut AS (SELECT sample, read_no, substr(r1_seq, 1, coalesce(b1.start, 999)) AS r1_seq, substr(r1_qual, 1, coalesce(b1.start,
  999)) AS r1_qual, substr(r2_seq, 1, coalesce(b2.start, 999)) AS r2_seq, substr(r2_qual, 1, coalesce(b2.start, 999)) AS r2_qual
  FROM kept LEFT JOIN b1 ON b1.s = r1_seq LEFT JOIN b2 ON b2.s = r2_seq),
back AS (SELECT * FROM both_cut WHERE length(r1_seq) >= 20 AND length(r2_seq) >= 20)"""


def pairs(spark, sf):
    return spread_small_scan(view(spark, sf, "pairs"))


@query("r2_trim_five_prime", _FRONT + " SELECT * FROM trimmed")
def _(spark, sf):
    return rd.trim_five_prime(pairs(spark, sf), FORWARD_PRIMER, REVERSE_PRIMER, indels=False)


def both_trimmed(spark, sf):
    first = rd.keep_trimmed(rd.trim_five_prime(pairs(spark, sf), FORWARD_PRIMER, REVERSE_PRIMER, indels=False))
    return rd.trim_three_prime(first.drop("status"), FORWARD_PRIMER, REVERSE_PRIMER, indels=False)


@query("r3_trim_three_prime", _BACK + " SELECT * FROM back")
def _(spark, sf):
    return both_trimmed(spark, sf)


# Pairs whose primers have lost or gained a base, at either end of a mate; some start inside the primer.
def _edited(seq: str, at: int, key: str) -> str:
    """SQL: a base deleted, inserted, changed or none, by the remainder of ``key``."""
    return (
        f"CASE {key} % 4 WHEN 1 THEN concat(substring({seq}, 1, {at}), substring({seq}, {at + 2})) WHEN 2 THEN "
        f"concat(substring({seq}, 1, {at}), 'GT', substring({seq}, {at + 2})) WHEN 3 THEN concat(substring({seq}, 1, {at}), "
        f"translate(substring({seq}, {at + 1}, 1), 'ACGT', 'CAAC'), substring({seq}, {at + 2})) ELSE {seq} END"
    )


VIEWS["indel_pairs"] = f"""
SELECT sample, read_no, substring(r1, 1 + lead % 6, 101) AS r1_seq, repeat('I', length(substring(r1, 1 + lead % 6, 101))) AS r1_qual,
  r2 AS r2_seq, repeat('H', length(r2)) AS r2_qual
FROM (SELECT concat('S', CAST(user_id % 12 AS STRING)) AS sample, event_id AS read_no, event_id % 3 AS lead, {_edited(
    '(' + _edited('amp', 5, 'event_id') + ')', 88, '(user_id % 5)')} AS r1, {_edited(
    '(' + _edited(_RCSQL.format(c='amp'), 9, '(event_id % 7)') + ')', 91, '(user_id % 3)')} AS r2
  FROM ({_AMPLICON}) x) y"""


def _place_edits(reads: str, primer: str, end: str) -> str:
    """Best placement per distinct read by edit distance over every start, length and primer part, as SQL."""
    m = len(primer)
    part, edge = ("right", "o = 0") if end == "front" else ("left", "o + l = length(s)")
    return f"""(SELECT s, first(o ORDER BY k - 2 * e DESC, abs(l - k), o, l) AS start, first(o + l ORDER BY k - 2 * e DESC, abs(l - k), o, l)
    AS stop FROM (SELECT s, o, k, l, levenshtein({part}('{primer}', k), substr(s, o + 1, l)) AS e FROM (SELECT s, CAST(o AS BIGINT) AS o,
    CAST(k AS BIGINT) AS k, CAST(k + d AS BIGINT) AS l FROM {reads}, range(0, 120) r(o), range(3, {m + 1}) p(k), range(-2, 3) b(d) WHERE
    abs(d) <= floor(k / 10)) WHERE o + l <= length(s) AND (k = {m} OR {edge})) WHERE e <= floor(k / 10) GROUP BY s)"""


_EDITED = ctes("indel_pairs") + f""",
d1 AS MATERIALIZED (SELECT DISTINCT r1_seq AS s FROM indel_pairs), d2 AS MATERIALIZED (SELECT DISTINCT r2_seq AS s FROM indel_pairs),
f1 AS MATERIALIZED {_place_edits('d1', FORWARD_PRIMER, 'front')}, f2 AS MATERIALIZED {_place_edits('d2', REVERSE_PRIMER, 'front')},
cut AS (SELECT p.sample, p.read_no, substr(r1_seq, coalesce(f1.stop, 0) + 1) AS r1_seq, substr(r1_qual, coalesce(f1.stop, 0)
  + 1) AS r1_qual, substr(r2_seq, coalesce(f2.stop, 0) + 1) AS r2_seq, substr(r2_qual, coalesce(f2.stop, 0) + 1) AS r2_qual,
  f1.stop IS NULL OR f2.stop IS NULL AS untrimmed FROM indel_pairs p LEFT JOIN f1 ON f1.s = r1_seq LEFT JOIN f2 ON f2.s = r2_seq),
trimmed AS (SELECT * EXCLUDE (untrimmed), CASE WHEN untrimmed THEN 'untrimmed' WHEN length(r1_seq) < 20 OR length(r2_seq) < 20
  THEN 'short' ELSE 'trimmed' END AS status FROM cut)"""
_EDITED_BACK = _EDITED + f""",
kept AS (SELECT * FROM trimmed WHERE status = 'trimmed'),
e1 AS MATERIALIZED (SELECT DISTINCT r1_seq AS s FROM kept), e2 AS MATERIALIZED (SELECT DISTINCT r2_seq AS s FROM kept),
b1 AS MATERIALIZED {_place_edits('e1', RRC, 'back')}, b2 AS MATERIALIZED {_place_edits('e2', FRC, 'back')},
both_cut AS (SELECT sample, read_no, substr(r1_seq, 1, coalesce(b1.start, 999)) AS r1_seq, substr(r1_qual, 1, coalesce(b1.start,
  999)) AS r1_qual, substr(r2_seq, 1, coalesce(b2.start, 999)) AS r2_seq, substr(r2_qual, 1, coalesce(b2.start, 999)) AS r2_qual
  FROM kept LEFT JOIN b1 ON b1.s = r1_seq LEFT JOIN b2 ON b2.s = r2_seq),
back AS (SELECT * FROM both_cut WHERE length(r1_seq) >= 20 AND length(r2_seq) >= 20)"""


def edited_trimmed(spark, sf):
    return rd.trim_five_prime(spread_small_scan(view(spark, sf, "indel_pairs")), FORWARD_PRIMER, REVERSE_PRIMER)


@query("r2_trim_with_indels", _EDITED + " SELECT * FROM trimmed")
def _(spark, sf):
    return edited_trimmed(spark, sf)


@query("r3_trim_back_with_indels", _EDITED_BACK + " SELECT * FROM back")
def _(spark, sf):
    first = rd.keep_trimmed(edited_trimmed(spark, sf)).drop("status")
    return rd.trim_three_prime(first, FORWARD_PRIMER, REVERSE_PRIMER)


# Whole-amplicon reads, every 3rd pair in the other orientation, some without a primer.
VIEWS["long_pairs"] = f"""
SELECT concat('S', CAST(user_id % 12 AS STRING)) AS sample, event_id AS read_no,
  CASE WHEN event_id % 3 = 0 THEN {_RCSQL.format(c='a')} ELSE a END AS r1_seq, repeat('I', 101) AS r1_qual,
  CASE WHEN event_id % 3 = 0 THEN a ELSE {_RCSQL.format(c='a')} END AS r2_seq, repeat('H', 101) AS r2_qual
FROM (SELECT event_id, user_id, CASE WHEN event_id % 7 = 2 THEN concat(substring(amp, 1, 60), repeat('A', 41)) WHEN event_id % 11
  = 3 THEN concat(repeat('G', 17), substring(amp, 18, 84)) ELSE amp END AS a FROM ({_AMPLICON}) x) y"""
_OK = "(read_no % 7 <> 2 AND read_no % 11 <> 3)"


@query(
    "r3_detect_orientation",
    ctes("long_pairs")
    + f" SELECT read_no, {_OK} AND read_no % 3 <> 0 AS as_expected, {_OK} AND read_no % 3 = 0 AS reversed FROM long_pairs",
)
def _(spark, sf):
    df = rd.detect_orientation(spread_small_scan(view(spark, sf, "long_pairs")), FORWARD_PRIMER, REVERSE_PRIMER)
    return df.select("read_no", "as_expected", "reversed")


@query(
    "u1_realign_union",
    ctes("long_pairs")
    + f""" SELECT sample, read_no, CASE WHEN read_no % 3 = 0 THEN r2_seq ELSE r1_seq END AS r1_seq, CASE WHEN read_no % 3 = 0 THEN
    r2_qual ELSE r1_qual END AS r1_qual, CASE WHEN read_no % 3 = 0 THEN r1_seq ELSE r2_seq END AS r2_seq, CASE WHEN read_no % 3 = 0
    THEN r1_qual ELSE r2_qual END AS r2_qual FROM long_pairs WHERE {_OK}""",
)
def _(spark, sf):
    return rd.realign(rd.detect_orientation(spread_small_scan(view(spark, sf, "long_pairs")), FORWARD_PRIMER, REVERSE_PRIMER))


# Tagged pairs of four libraries: tag of the sample on both mates, its reverse complement behind.
_TAGSQL = "substring(translate(md5(concat('tag', CAST({c} AS STRING))), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 8)"
VIEWS["tagged"] = f"""
SELECT event_id AS read_no, concat('LIB', CAST(user_id % 4 AS STRING)) AS library,
  concat(CASE WHEN event_id % 9 = 4 THEN 'NNNNNNNN' ELSE tag END, ins, {_RCSQL.format(c='tag')}) AS r1_seq,
  concat(repeat('A', 8), repeat('B', 32), repeat('C', 8)) AS r1_qual,
  concat(CASE WHEN event_id % 13 = 5 THEN 'TTTTTTTT' ELSE tag END, {_RCSQL.format(c='ins')}, 'ACGTACGT') AS r2_seq,
  concat(repeat('D', 8), repeat('E', 40)) AS r2_qual
FROM (SELECT event_id, user_id, {_TAGSQL.format(c='user_id % 12')} AS tag, translate(md5(CAST(event_id % 97 AS STRING)),
  '0123456789abcdef', 'ACGTACGTACGTACGT') AS ins FROM {{events}}) t"""
VIEWS["tag_table"] = f"""
SELECT DISTINCT concat('LIB', CAST(user_id % 4 AS STRING)) AS library, CASE WHEN user_id % 12 = 11 THEN 'Unknown' ELSE
  concat('unknown-site-', CAST(user_id % 12 AS STRING)) END AS sample, {_TAGSQL.format(c='user_id % 12')} AS tag FROM {{events}}
UNION ALL SELECT 'LIB1', 'empty', 'ACGTACGTAC' UNION ALL SELECT 'LIB2', 'e1', 'AAAAAAAAAA' UNION ALL SELECT 'LIB2', 'e2',
  'CCCCCCCCCC' UNION ALL SELECT 'LIB2', 'e3', 'GGGGGGGGGG' UNION ALL SELECT 'LIB2', 'e4', 'GGGGGGGGGT'"""
_DEMUX = ctes("tagged", "tag_table") + f""",
demux AS (SELECT t.library, k.sample, read_no, substring(r1_seq, 9, 32) AS r1_seq, substring(r1_qual, 9, 32) AS r1_qual,
  CASE WHEN right(r2_seq, 8) = {_RCSQL.format(c='tag')} THEN substring(r2_seq, 9, 32) ELSE substring(r2_seq, 9) END AS r2_seq,
  CASE WHEN right(r2_seq, 8) = {_RCSQL.format(c='tag')} THEN substring(r2_qual, 9, 32) ELSE substring(r2_qual, 9) END AS r2_qual
  FROM tagged t JOIN tag_table k ON k.library = t.library AND starts_with(r1_seq, tag) AND starts_with(r2_seq, tag) WHERE
  lower(k.sample) <> 'unknown')"""


@query("r4_demultiplex", _DEMUX + " SELECT * FROM demux")
def _(spark, sf):
    return tg.demultiplex(view(spark, sf, "tagged"), view(spark, sf, "tag_table"), 0)


@query(
    "r4_sample_failures",
    _DEMUX
    + """, a AS (SELECT library, sample, (SELECT count(*) FROM demux d WHERE d.library = t.library AND d.sample = t.sample) AS n
    FROM (SELECT DISTINCT library, sample FROM tag_table WHERE lower(sample) <> 'unknown') t) SELECT library, count(*) AS
    n_samples, count(CASE WHEN n = 0 THEN 1 END) AS n_empty, count(CASE WHEN n = 0 THEN 1 END) / count(*) > 0.5 AS failed FROM a
    GROUP BY library""",
)
def _(spark, sf):
    tags = view(spark, sf, "tag_table")
    return rd.sample_failures(tg.demultiplex(view(spark, sf, "tagged"), tags, 0), tags)


# The same with a spacer of up to five bases before the tags, and tags with ambiguity codes; two samples share a tag.
VIEWS["spaced"] = """
SELECT read_no, library, concat(substring('TGACT', 1, CAST(read_no % 6 AS INT)), r1_seq) AS r1_seq, concat(repeat('#', CAST(read_no % 6
  AS INT)), r1_qual) AS r1_qual, concat(substring('GTCAG', 1, CAST(read_no % 4 AS INT)), r2_seq) AS r2_seq, concat(repeat('#',
  CAST(read_no % 4 AS INT)), r2_qual) AS r2_qual FROM tagged"""
VIEWS["vague_tags"] = """
SELECT library, sample, concat(substring(tag, 1, 2), CASE WHEN substring(tag, 3, 1) IN ('A', 'G') THEN 'R' ELSE 'Y' END, substring(tag, 4, 2),
  CASE WHEN library = 'LIB0' THEN 'N' ELSE substring(tag, 6, 1) END, substring(tag, 7)) AS tag FROM tag_table
UNION ALL SELECT library, concat(sample, '-twin'), tag FROM tag_table WHERE library = 'LIB3' AND sample LIKE '%-7'"""
_PATTERN = "'^' || replace(replace(replace(tag, 'R', '[AG]'), 'Y', '[CT]'), 'N', '[ACGT]') || '$'"
_BEHIND = f"replace(replace(replace({_RCSQL.format(c='tag').replace('ACGT', 'ACGTRYN').replace('TGCA', 'TGCAYRN')}, 'R', '[AG]'), 'Y', '[CT]'), 'N', '[ACGT]') || '$'"


def _tag_at(mate: str) -> str:
    found = f"regexp_matches(substr({mate}_seq, o + 1, length(tag)), {_PATTERN})"
    return f"""(SELECT read_no, t.library, sample, tag, min(o) AS o FROM spaced t JOIN vague_tags k ON k.library = t.library, range(0, 6) g(o)
  WHERE {found} AND lower(sample) <> 'unknown' GROUP BY ALL)"""


def _without_tag(mate: str, part: str) -> str:
    seq, place = f"{mate}_seq", f"c.o{mate[1]}"
    tail = f"CASE WHEN regexp_matches(substr({seq}, {place} + length(tag) + 1), {_BEHIND}) THEN length(tag) ELSE 0 END"
    return f"substr({mate}_{part}, {place} + length(tag) + 1, length({seq}) - {place} - length(tag) - {tail}) AS {mate}_{part}"


_SPACED = ctes("tagged", "tag_table") + "".join(f", {n} AS ({VIEWS[n].strip()})" for n in ("spaced", "vague_tags")) + f""",
cand AS (SELECT a.*, a.o AS o1, b.o AS o2, row_number() OVER w AS rn, a.o + b.o AS cost FROM {_tag_at('r1')} a JOIN {_tag_at('r2')} b
  USING (read_no, sample, tag) WINDOW w AS (PARTITION BY read_no ORDER BY a.o + b.o, length(tag) DESC)),
best AS (SELECT read_no, count(DISTINCT sample) AS n FROM cand JOIN (SELECT read_no, min(cost * 100 - length(tag)) AS least FROM cand GROUP BY
  read_no) USING (read_no) WHERE cost * 100 - length(tag) = least GROUP BY read_no)"""


def _spaced(spark, sf):
    tables = {n: view(spark, sf, n) for n in ("tagged", "tag_table")}
    return spark.sql(VIEWS["spaced"].replace("FROM tagged", "FROM {tagged}"), tagged=tables["tagged"]), spark.sql(
        VIEWS["vague_tags"].replace("FROM tag_table", "FROM {tag_table}"), tag_table=tables["tag_table"]
    )


@query(
    "r4_demultiplex_spaced",
    _SPACED + f""" SELECT c.library, c.sample, read_no, {', '.join(_without_tag(m, p) for m in ('r1', 'r2') for p in ('seq', 'qual'))} FROM cand c
    JOIN best USING (read_no) JOIN spaced USING (read_no) WHERE rn = 1 AND n = 1""",
)
def _(spark, sf):
    return tg.demultiplex(*_spaced(spark, sf))


@query(
    "r4_tag_report",
    _SPACED + """ SELECT library, count(CASE WHEN n = 1 THEN 1 END) AS assigned, count(CASE WHEN n > 1 THEN 1 END) AS ambiguous, count(CASE WHEN
    n IS NULL THEN 1 END) AS unmatched FROM spaced LEFT JOIN best USING (read_no) GROUP BY library""",
)
def _(spark, sf):
    return tg.tag_report(*_spaced(spark, sf))


_LEN = "coalesce(nullif(length(regexp_extract({c}, '^[^!-,]*')), -1), length({c}))"
_EEOF = "list_sum(list_transform(range(1, length({c}) + 1), lambda i: pow(10.0, -(ascii(substr({c}, i, 1)) - 33) / 10.0)))"
_QUAL = ctes("pairs") + f""",
k AS (SELECT *, {_LEN.format(c='r1_qual')} AS k1, {_LEN.format(c='r2_qual')} AS k2 FROM pairs),
t AS (SELECT sample, read_no, substr(r1_seq, 1, k1) AS r1_seq, substr(r1_qual, 1, k1) AS r1_qual, substr(r2_seq, 1, k2) AS r2_seq,
  substr(r2_qual, 1, k2) AS r2_qual FROM k WHERE k1 >= 20 AND k2 >= 20),
passed AS (SELECT * FROM t WHERE NOT contains(r1_seq, 'N') AND NOT contains(r2_seq, 'N') AND {_EEOF.format(c='r1_qual')} <= 2 AND
  {_EEOF.format(c='r2_qual')} <= 2)"""


@query("r5_quality_filter", _QUAL + " SELECT * FROM passed")
def _(spark, sf):
    return rd.filter_quality(pairs(spark, sf))


@query(
    "r5_expected_errors",
    ctes("pairs") + f" SELECT read_no, round({_EEOF.format(c='r1_qual')}, 6) AS ee FROM pairs",
)
def _(spark, sf):
    return pairs(spark, sf).select("read_no", F.round(expected_errors("r1_qual"), 6).alias("ee"))


@query(
    "r5_without_spike_in",
    ctes("pairs") + " SELECT * FROM pairs WHERE read_no % 97 NOT IN (3, 4)",
)
def _(spark, sf):
    p = pairs(spark, sf)
    amps = view(spark, sf, "amplicons").where("event_id IN (3, 4)").select("amp").collect()
    return without_genome(p, "".join(r[0][17:81] for r in amps), min_hits=1)


VIEWS["amplicons"] = _AMPLICON


def _merge_sql(source: str, lo: int, maxd: int) -> str:
    """Merge of distinct trimmed pairs by Hamming distance over every overlap."""
    rc = _RCSQL.format(c="r2")
    return f""",
u AS (SELECT DISTINCT r1_seq AS r1, r2_seq AS r2, {rc.replace('r2', 'r2_seq')} AS rc FROM {source}),
o AS (SELECT r1, r2, rc, k, hamming(right(r1, k), left(rc, k)) AS e FROM (SELECT r1, r2, rc, CAST(k AS BIGINT) AS k FROM u,
  range({lo}, 80) g(k) WHERE k <= length(r1) AND k <= length(rc))),
w AS (SELECT r1, r2, any_value(rc) AS rc, first(k ORDER BY k - 2 * e DESC, e) AS k, first(e ORDER BY k - 2 * e DESC, e) AS e FROM o
  WHERE e <= {maxd} GROUP BY r1, r2),
merged AS (SELECT p.sample, p.read_no, concat(r1, substr(rc, k + 1)) AS sequence, CAST(k AS INT) AS overlap, CAST(e AS INT) AS
  mismatches FROM {source} p JOIN w ON w.r1 = p.r1_seq AND w.r2 = p.r2_seq)"""


_MERGED = _BACK + _merge_sql("back", 20, 0)


def merged(spark, sf):
    return rd.merge_mates(both_trimmed(spark, sf), min_overlap=20, max_diffs=0)


@query("r6_merge_mates", _MERGED + " SELECT * FROM merged WHERE NOT contains(sequence, 'N')")
def _(spark, sf):
    return merged(spark, sf).drop("quality")


@query(
    "r6_samples_without_merge",
    _MERGED
    + """ SELECT DISTINCT concat(sample, '-', CAST(read_no % 97 AS VARCHAR)) AS sample FROM pairs WHERE concat(sample, '-',
    CAST(read_no % 97 AS VARCHAR)) NOT IN (SELECT concat(sample, '-', CAST(read_no % 97 AS VARCHAR)) FROM merged WHERE NOT
    contains(sequence, 'N'))""",
)
def _(spark, sf):
    def fine(df):
        return df.withColumn("sample", F.concat_ws("-", "sample", (F.col("read_no") % 97).cast("string")))

    return rd.samples_without_merge(fine(pairs(spark, sf)), fine(merged(spark, sf)))
