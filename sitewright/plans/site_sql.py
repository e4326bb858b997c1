"""DuckDB SQL for the queries on the reads, fragments, sites and sample tables."""

from __future__ import annotations

from sitewright.operators.sequences import GOLAY_PARITY

_SAMPLE = "trial, subject, sample"
_SCOPE = f"{_SAMPLE}, refgenome, mode"


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '^[\s\x{{00a0}}]+|[\s\x{{00a0}}]+$', '', 'g')"


def _norm(c: str) -> str:
    inner = rf"regexp_replace({_strip(c)}, '[\s\x{{00a0}}]+', '_', 'g')"
    return f"translate({inner}, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"


def _spot(c: str) -> str:
    """chrom, strand, pos of a position string."""
    t = f"lower({_strip(c)})"
    return (
        f"'chr' || upper(regexp_extract({t}, '^chr([^+-]+)[+-]', 1)) AS chrom, regexp_extract({t}, '^[^+-]+([+-])', 1) AS strand, "
        f"CAST(round(CAST(regexp_extract({t}, '^[^+-]+[+-](.*)$', 1) AS DOUBLE)) AS BIGINT) AS pos"
    )


_FRAGS = "frags AS (SELECT *, fragend - fragstart + 1 AS width FROM buildstdfragments)"
_CLUSTERED = f"clustered AS (SELECT *, fragend - fragstart + 1 AS width, {_strip('clusterid')} AS cluster FROM buildstdfragments WHERE {_strip('clusterid')} NOT IN ('', 'NA'))"
_SITES = f"known AS (SELECT {_spot('posid')}, nreads, {_SAMPLE} FROM known_sites WHERE posid IS NOT NULL)"
_SPOTS = f"{_SITES}, spots AS (SELECT DISTINCT chrom, pos FROM known)"
_GENES = "genes AS (SELECT DISTINCT fragchromosome AS chrom, CAST(fragstart AS BIGINT) AS start, CAST(fragend AS BIGINT) AS \"end\", fragstrand AS strand, posid AS gene FROM buildstdfragments WHERE fragstart <= fragend)"
_NPOS = "npos AS (SELECT readid, count(DISTINCT posid) AS n_positions FROM buildstdfragments GROUP BY 1)"
_MODAL = """SELECT {k}, {v} AS {name} FROM (SELECT {k}, {v}, row_number() OVER (PARTITION BY {k} ORDER BY count(*) DESC, {v}) AS rn FROM {src} WHERE {v} IS NOT NULL GROUP BY {k}, {v}) WHERE rn = 1"""
_SITE = f"{_SCOPE}, posid"
_FRAGMENT = f"{_SITE}, replicate, fragstart, fragend"
_ROLLED = f"""pr AS (SELECT {_SITE}, replicate, sum(nreads) AS r, count(DISTINCT width) AS w FROM frags WHERE posid IS NOT NULL GROUP BY ALL),
  st AS (SELECT {_SITE}, CAST(sum(r) AS BIGINT) AS reads, CAST(sum(w) AS BIGINT) AS sonic_lengths, count(*) AS n_reps_obs FROM pr GROUP BY ALL),
  sw AS (SELECT {_SITE}, count(DISTINCT width) AS sonic_lengths_sample FROM frags WHERE posid IS NOT NULL GROUP BY ALL)"""
_NEAR = """dist AS (SELECT chrom, pos, start, "end", greatest(start - pos, pos - "end", 0) AS distance FROM spots JOIN iv USING (chrom)),
  near AS (SELECT * FROM dist QUALIFY distance = min(distance) OVER (PARTITION BY chrom, pos))"""

#: The rows of the code's parity part, the first column as the lowest bit.
_PARITY = str([sum(int(bit) << i for i, bit in enumerate(row)) for row in GOLAY_PARITY])

SQL = {
    "dup_collapse": "SELECT lang, source, md5(text) AS text_md5, count(*) AS n_reads, min(doc_id) AS first_doc FROM documents GROUP BY 1, 2, 3",
    "id_normalize": f"""WITH x AS (SELECT sample_id, {_norm("trial")} AS trial, {_norm("subject")} AS subject, {_norm("sample")} AS sample FROM samples)
  SELECT *, coalesce(regexp_full_match(trial, '[A-Z0-9_.\\-]+') AND trial <> 'NA', false) AND coalesce(regexp_full_match(subject, '[A-Z0-9_.\\-]+') AND subject <> 'NA', false)
    AND coalesce(regexp_full_match(sample, '[A-Z0-9_.\\-]+') AND sample <> 'NA', false) AS is_valid FROM x""",
    "revcomp_polyg": f"""WITH x AS (SELECT upper({_strip("leaderseq")}) AS leader, count(*) AS n FROM known_sites WHERE leaderseq IS NOT NULL GROUP BY 1)
  SELECT leader, n, reverse(translate(leader, 'ACGTN', 'TGCAN')) AS rc, regexp_replace(leader, 'G{{3,}}[ATCN]?G{{2,}}.*$', '') AS trimmed FROM x""",
    "barcode_assign": """WITH b AS (SELECT DISTINCT upper(index1seq) AS barcode FROM sampledata WHERE length(index1seq) = 12),
  u AS (SELECT DISTINCT umi FROM buildstdfragments WHERE length(umi) = 12),
  m AS (SELECT umi, min(barcode) AS barcode, count(*) AS n FROM u JOIN b ON hamming(umi, barcode) <= 1 GROUP BY 1 HAVING count(*) = 1),
  r AS (SELECT readid, min(barcode) AS barcode FROM (SELECT DISTINCT readid, umi FROM buildstdfragments) JOIN m USING (umi) GROUP BY 1 HAVING count(*) = 1)
  SELECT barcode, count(*) AS n_reads FROM r GROUP BY 1""",
    "unique_multi_split": f"""WITH {_NPOS} SELECT {_SAMPLE}, count(*) FILTER (WHERE n_positions = 1) AS n_unique, count(*) FILTER (WHERE n_positions > 1) AS n_multi, max(n_positions) AS most_positions
  FROM (SELECT DISTINCT readid, {_SAMPLE} FROM buildstdfragments) JOIN npos USING (readid) GROUP BY ALL""",
    "multihit_rescue": """WITH b AS (SELECT readid, refgenome, concat_ws(':', fragchromosome, CAST(floor(fragstart / 1000000.0) AS BIGINT)) AS region FROM buildstdfragments),
  n AS (SELECT readid, count(DISTINCT region) AS n FROM b GROUP BY 1), f AS (SELECT * FROM b JOIN n USING (readid)),
  u AS (SELECT DISTINCT refgenome, region FROM f WHERE n = 1), m AS (SELECT DISTINCT readid, refgenome, region FROM f WHERE n > 1)
  SELECT readid, refgenome, min(region) AS region FROM m JOIN u USING (refgenome, region) GROUP BY ALL HAVING count(*) = 1""",
    "fuzzy_break_pick": """SELECT readid, posid, fragstart, fragend FROM (SELECT DISTINCT readid, posid, fragstart, fragend FROM buildstdfragments WHERE posid IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY readid, posid ORDER BY fragend - fragstart, fragstart) = 1""",
    "multihit_components": f"""WITH RECURSIVE {_NPOS}, m AS (SELECT {_SCOPE}, readid, posid, nreads FROM buildstdfragments JOIN npos USING (readid) WHERE n_positions > 1 AND posid IS NOT NULL),
  d AS (SELECT DISTINCT {_SCOPE}, readid, posid FROM m), k AS (SELECT *, min(readid) OVER (PARTITION BY {_SCOPE}, posid) AS head FROM d),
  e AS (SELECT {_SCOPE}, readid AS u, head AS v FROM k UNION SELECT {_SCOPE}, head, readid FROM k),
  reach AS (SELECT DISTINCT {_SCOPE}, readid, readid AS cluster FROM d UNION SELECT {", ".join("e." + c.strip() for c in _SCOPE.split(","))}, e.v, reach.cluster
    FROM reach JOIN e ON {" AND ".join(f"e.{c.strip()} IS NOT DISTINCT FROM reach.{c.strip()}" for c in _SCOPE.split(","))} AND e.u = reach.readid),
  g AS (SELECT {_SCOPE}, readid, min(cluster) AS cluster FROM reach GROUP BY ALL)
  SELECT {", ".join("m." + c.strip() for c in _SCOPE.split(","))}, cluster, count(DISTINCT m.readid) AS n_reads, count(DISTINCT posid) AS n_positions, CAST(sum(nreads) AS BIGINT) AS reads
  FROM m JOIN g ON {" AND ".join(f"m.{c.strip()} IS NOT DISTINCT FROM g.{c.strip()}" for c in _SCOPE.split(","))} AND m.readid = g.readid GROUP BY ALL""",
    "multihit_cluster_summary": f"""WITH {_CLUSTERED}, p AS (SELECT {_SCOPE}, cluster, posid, count(DISTINCT width) AS lengths, count(DISTINCT readid) AS reads FROM clustered GROUP BY ALL),
  n AS (SELECT {_SCOPE}, cluster, count(posid) AS n_positions, string_agg(concat_ws(':', posid, lengths, reads), ',' ORDER BY concat_ws(':', posid, lengths, reads)) AS nodes FROM p GROUP BY ALL),
  s AS (SELECT {_SCOPE}, cluster, count(DISTINCT readid) AS n_reads, count(DISTINCT umi) AS n_umis, CAST(sum(nreads) AS BIGINT) AS reads FROM clustered GROUP BY ALL)
  SELECT * FROM s JOIN n USING ({_SCOPE}, cluster)""",
    "anchor_competition": f"""WITH r AS (SELECT sample, repleaderseq AS anchor, trial, subject, refgenome, mode, posid, count(DISTINCT (fragstart, fragend)) AS frags, count(*) AS reads
    FROM buildstdfragments WHERE repleaderseq IS NOT NULL AND posid IS NOT NULL GROUP BY ALL),
  k AS (SELECT *, row_number() OVER (PARTITION BY sample, anchor ORDER BY frags DESC, reads DESC, trial, subject, refgenome, mode, posid) AS f,
    row_number() OVER (PARTITION BY sample, anchor ORDER BY reads DESC, frags DESC, trial, subject, refgenome, mode, posid) AS g FROM r),
  t AS (SELECT sample, anchor, max(frags) FILTER (WHERE f = 1) AS f1, max(frags) FILTER (WHERE f = 2) AS f2, max(reads) FILTER (WHERE g = 1) AS r1, max(reads) FILTER (WHERE g = 2) AS r2 FROM k GROUP BY ALL),
  d AS (SELECT sample, anchor, CASE WHEN f2 IS NULL THEN 'single' WHEN f1 - f2 >= 2 THEN 'fragments' WHEN r1 >= 3 * r2 THEN 'reads' ELSE 'removed' END AS decision FROM t)
  SELECT d.sample, d.anchor, decision, k.trial, k.subject, k.refgenome, k.mode, k.posid FROM d LEFT JOIN k ON d.sample = k.sample AND d.anchor = k.anchor
    AND ((decision IN ('single', 'fragments') AND f = 1) OR (decision = 'reads' AND g = 1))""",
    "fragment_rollup": f"""WITH s AS (SELECT {_FRAGMENT}, CAST(sum(nreads) AS BIGINT) AS reads, count(*) AS n_records, count(DISTINCT readid) AS n_distinct_reads FROM buildstdfragments WHERE posid IS NOT NULL GROUP BY ALL HAVING sum(nreads) >= 1),
  m AS ({_MODAL.format(k=_FRAGMENT, v="repleaderseq", name="rep_leader", src="buildstdfragments")})
  SELECT s.*, m.rep_leader FROM s LEFT JOIN m USING ({_FRAGMENT})""",
    "site_rollup": f"WITH {_FRAGS}, {_ROLLED} SELECT st.*, sonic_lengths_sample, round(100.0 * sonic_lengths / sum(sonic_lengths) OVER (PARTITION BY {_SAMPLE}, refgenome), 2) AS percent_rel_abund FROM st JOIN sw USING ({_SITE})",
    "site_rollup_pivot": f"WITH {_FRAGS}, {_ROLLED} SELECT {_SITE}, "
    + ", ".join(f"CAST(max(r) FILTER (WHERE replicate = {i}) AS BIGINT) AS rep{i}_reads, max(w) FILTER (WHERE replicate = {i}) AS rep{i}_sonic_lengths" for i in (1, 2, 3, 4))
    + f" FROM pr GROUP BY {_SITE}",
    "consensus_leaders": f"""WITH {_FRAGS}, c AS (SELECT {_SITE}, repleaderseq, count(DISTINCT width) AS w, sum(nreads) AS r FROM frags WHERE posid IS NOT NULL AND repleaderseq IS NOT NULL GROUP BY ALL)
  SELECT {_SITE}, repleaderseq AS rep_leader FROM c QUALIFY row_number() OVER (PARTITION BY {_SITE} ORDER BY w DESC, r DESC, repleaderseq) = 1""",
    "metadata_collapse": f"SELECT {_SCOPE}, string_agg(DISTINCT vectorfastafile, ';' ORDER BY vectorfastafile) AS vectors FROM buildstdfragments WHERE posid IS NOT NULL AND trim(vectorfastafile) <> '' GROUP BY ALL",
    "orientation_correct": f"""WITH x AS (SELECT mode, {_spot("posid")} FROM buildstdfragments WHERE mode IN ('U3', 'U5') AND posid IS NOT NULL)
  SELECT mode, chrom || CASE WHEN mode = 'U3' THEN CASE WHEN strand = '+' THEN '-' ELSE '+' END ELSE strand END || (CASE WHEN strand = '+' THEN pos + 2 ELSE pos - 2 END) AS posid, count(*) AS n FROM x GROUP BY ALL""",
    "dual_pairs": f"""WITH x AS (SELECT DISTINCT mode, {_spot("posid")} FROM buildstdfragments WHERE mode IN ('U3', 'U5') AND posid IS NOT NULL),
  p AS (SELECT a.chrom, b.strand, a.pos AS u5_pos, b.pos AS u3_pos FROM x a JOIN x b ON a.chrom = b.chrom AND a.strand <> b.strand AND abs(a.pos - b.pos) <= 5000 WHERE a.mode = 'U5' AND b.mode = 'U3')
  SELECT * FROM p QUALIFY count(*) OVER (PARTITION BY chrom, strand, u5_pos) = 1 AND count(*) OVER (PARTITION BY chrom, strand, u3_pos) = 1""",
    "nearest_interval": f"""WITH {_SPOTS}, iv AS (SELECT DISTINCT fragchromosome AS chrom, CAST(fragstart AS BIGINT) AS start, CAST(fragend AS BIGINT) AS "end" FROM buildstdfragments WHERE fragstart <= fragend), {_NEAR} SELECT chrom, pos, distance, start, "end" FROM near""",
    "nearest_genes": f"""WITH {_SPOTS}, {_GENES},
  d AS (SELECT s.chrom, s.pos, g.start, g."end", g.strand, g.gene, greatest(g.start - s.pos, s.pos - g."end", 0) AS distance FROM spots s JOIN genes g ON s.chrom = g.chrom),
  h AS (SELECT * FROM d QUALIFY distance = min(distance) OVER (PARTITION BY chrom, pos)),
  o AS (SELECT chrom, pos, gene, strand, (min((start, "end", gene, strand))) AS k FROM h GROUP BY chrom, pos, gene, strand),
  g AS (SELECT chrom, pos, string_agg(gene, ',' ORDER BY k) AS nearest_gene, string_agg(strand, ',' ORDER BY k) AS nearest_strand FROM o GROUP BY 1, 2),
  m AS (SELECT chrom, pos, min(distance) AS nearest_dist, pos < min(start) AS before_nearest FROM h GROUP BY 1, 2),
  e AS (SELECT DISTINCT s.chrom, s.pos FROM spots s JOIN genes x ON s.chrom = x.chrom AND s.pos BETWEEN x.start AND x."end" AND x."end" - x.start > 300)
  SELECT s.chrom, s.pos, coalesce(nearest_dist = 0, false) AS in_gene, e.pos IS NOT NULL AS in_exon, nearest_gene, nearest_dist, nearest_strand, before_nearest
  FROM spots s LEFT JOIN g ON s.chrom = g.chrom AND s.pos = g.pos LEFT JOIN m ON s.chrom = m.chrom AND s.pos = m.pos LEFT JOIN e ON s.chrom = e.chrom AND s.pos = e.pos""",
    "interval_overlap": f"""WITH {_SPOTS}, {_GENES} SELECT DISTINCT s.chrom, pos, start, "end" FROM spots s JOIN genes g ON s.chrom = g.chrom AND pos BETWEEN start AND "end" """,
    "repeat_annotate": f"""WITH {_SPOTS}, r AS (SELECT DISTINCT fragchromosome AS chrom, fragstart AS start, fragend AS e, vectorfastafile AS name, mode AS class, concat_ws(':', vectorfastafile, mode) AS ord FROM buildstdfragments WHERE fragstart <= fragend),
  h AS (SELECT DISTINCT s.chrom, s.pos, ord, name, class FROM spots s JOIN r ON s.chrom = r.chrom AND s.pos BETWEEN r.start AND r.e),
  a AS (SELECT chrom, pos, string_agg(name, ',' ORDER BY o) AS repeat_name FROM (SELECT chrom, pos, name, min(ord) AS o FROM h GROUP BY ALL) GROUP BY 1, 2),
  b AS (SELECT chrom, pos, string_agg(class, ',' ORDER BY o) AS repeat_class FROM (SELECT chrom, pos, class, min(ord) AS o FROM h GROUP BY ALL) GROUP BY 1, 2)
  SELECT s.chrom, s.pos, repeat_name, repeat_class FROM spots s LEFT JOIN a ON s.chrom = a.chrom AND s.pos = a.pos LEFT JOIN b ON s.chrom = b.chrom AND s.pos = b.pos""",
    "dominant_class": f"""WITH {_CLUSTERED}, v AS (SELECT DISTINCT {_SCOPE}, cluster, posid, coalesce(leaderseqhmm, 'none') AS class FROM clustered WHERE posid IS NOT NULL),
  c AS (SELECT {_SCOPE}, cluster, class, count(*) AS n FROM v GROUP BY ALL), z AS (SELECT {_SCOPE}, cluster, count(DISTINCT posid) AS members FROM v GROUP BY ALL),
  b AS (SELECT * FROM c QUALIFY n = max(n) OVER (PARTITION BY {_SCOPE}, cluster)),
  l AS (SELECT {_SCOPE}, cluster, count(*) AS k, max(n) AS n, string_agg(class, ',' ORDER BY class) AS leads FROM b GROUP BY ALL)
  SELECT {_SCOPE}, cluster, CASE WHEN k > 1 THEN 'tie' ELSE leads END AS dominant_class, round(100.0 * n / members, 2) AS dominant_percent, CASE WHEN k > 1 THEN leads END AS tied_classes FROM l JOIN z USING ({_SCOPE}, cluster)""",
    "score_heatmap": f"""WITH {_FRAGS}, b AS (SELECT leaderseqhmm, CAST(floor(width / 25.0) * 25 AS BIGINT) AS x_bin, CAST(floor(nreads / 3.0) * 3 AS BIGINT) AS y_bin, CAST(sum(nreads) AS BIGINT) AS weight FROM frags WHERE leaderseqhmm IS NOT NULL GROUP BY ALL)
  SELECT *, round(100.0 * weight / sum(weight) OVER (PARTITION BY leaderseqhmm), 4) AS percent FROM b""",
    "sequence_consensus": f"""WITH s AS (SELECT upper({_strip("leaderseq")}) AS seq FROM known_sites WHERE leaderseq IS NOT NULL),
  n AS (SELECT seq, row_number() OVER (ORDER BY substr(seq, 1, 20), seq) AS rn, count(*) OVER () AS t FROM s WHERE length(seq) > 0),
  b AS (SELECT seq, CAST((rn * 50 + t - 1) // t AS INTEGER) AS bin FROM n),
  l AS (SELECT bin, i AS position, substr(seq, i, 1) AS base, count(*) AS k FROM b, (SELECT unnest(range(1, (SELECT max(length(seq)) + 1 FROM s))) AS i) WHERE i <= length(seq) GROUP BY ALL),
  t AS (SELECT bin, position, sum(k) AS total FROM l GROUP BY ALL),
  w AS (SELECT * FROM l WHERE base IN ('A', 'C', 'G', 'T') QUALIFY row_number() OVER (PARTITION BY bin, position ORDER BY k DESC, base) = 1)
  SELECT t.bin, t.position, w.base, round(w.k / t.total::DOUBLE, 6) AS agreement FROM t LEFT JOIN w ON t.bin = w.bin AND t.position = w.position""",
    "sequence_consensus_genomic": f"""WITH s AS (SELECT upper({_strip("leaderseq")}) AS seq FROM known_sites WHERE leaderseq IS NOT NULL),
  n AS (SELECT seq, row_number() OVER (ORDER BY substr(seq, 1, 20), substr(seq, 50, 11), seq) AS rn, count(*) OVER () AS t FROM s WHERE length(seq) > 0),
  b AS (SELECT seq, CAST((rn * 50 + t - 1) // t AS INTEGER) AS bin FROM n),
  l AS (SELECT bin, i AS position, substr(seq, i, 1) AS base, count(*) AS k FROM b, (SELECT unnest(range(1, (SELECT max(length(seq)) + 1 FROM s))) AS i) WHERE i <= length(seq) GROUP BY ALL),
  t AS (SELECT bin, position, sum(k) AS total FROM l GROUP BY ALL),
  w AS (SELECT * FROM l WHERE base IN ('A', 'C', 'G', 'T') QUALIFY row_number() OVER (PARTITION BY bin, position ORDER BY k DESC, base) = 1)
  SELECT t.bin, t.position, w.base, round(w.k / t.total::DOUBLE, 6) AS agreement FROM t LEFT JOIN w ON t.bin = w.bin AND t.position = w.position""",
    "heatmap_range": f"""WITH {_FRAGS}, b AS (SELECT leaderseqhmm, CAST(floor(width / 25.0) * 25 AS BIGINT) AS x_bin, CAST(floor(nreads / 3.0) * 3 AS BIGINT) AS y_bin, CAST(sum(nreads) AS BIGINT) AS weight FROM frags WHERE leaderseqhmm IS NOT NULL GROUP BY ALL),
  h AS (SELECT *, round(100.0 * weight / sum(weight) OVER (PARTITION BY leaderseqhmm), 4) AS percent FROM b)
  SELECT leaderseqhmm, min(x_bin) AS x_from, max(x_bin) AS x_to, min(y_bin) AS y_from, max(y_bin) AS y_to, CAST(sum(weight) AS BIGINT) AS weight_shown FROM h WHERE percent >= 2 GROUP BY 1""",
    "recovery_summary": f"""WITH {_SITES}, t AS (SELECT DISTINCT chrom, strand, pos FROM known), o AS (SELECT DISTINCT {_spot("posid")} FROM buildstdfragments WHERE posid IS NOT NULL),
  n AS (SELECT t.chrom, t.strand, t.pos AS a, o.pos AS b FROM t JOIN o ON t.chrom = o.chrom AND t.strand = o.strand AND abs(t.pos - o.pos) <= 5),
  c AS (SELECT (SELECT count(*) FROM t) AS e, (SELECT count(*) FROM o) AS s, (SELECT count(*) FROM (SELECT DISTINCT chrom, strand, a FROM n)) AS r, (SELECT count(*) FROM (SELECT DISTINCT chrom, strand, b FROM n)) AS x)
  SELECT e AS n_expected, r AS n_recovered, e - r AS n_missing, s AS n_sites, s - x AS n_imagined, round(100.0::DOUBLE * r / e, 2) AS percent_recovered FROM c""",
    "topk_barcodes": """WITH i AS (SELECT upper(index1seq) AS barcode, count(*) AS barcode_n FROM sampledata GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10),
  p AS (SELECT upper(index1seq) || ':' || upper(adriftreadlinkerseq) AS pair, count(*) AS pair_n FROM sampledata GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
  SELECT * FROM (SELECT *, CAST(row_number() OVER (ORDER BY barcode_n DESC, barcode) AS INTEGER) AS rank FROM i) FULL JOIN (SELECT *, CAST(row_number() OVER (ORDER BY pair_n DESC, pair) AS INTEGER) AS rank FROM p) USING (rank)""",
    "stage_attrition": """WITH u AS (
    SELECT subject, sample, CAST(sum(demultiplexed_reads) AS BIGINT) AS a, NULL::BIGINT AS b, NULL::BIGINT AS c, NULL::BIGINT AS d, NULL::BIGINT AS e FROM samples GROUP BY ALL UNION ALL
    SELECT subject, sample, NULL, count(*), NULL, NULL, NULL FROM sampledata GROUP BY ALL UNION ALL
    SELECT subject, sample, NULL, NULL, count(*), NULL, NULL FROM buildstdfragments GROUP BY ALL UNION ALL
    SELECT subject, sample, NULL, NULL, NULL, CAST(sum(total_clusters) AS BIGINT), NULL FROM multihit_clusters GROUP BY ALL UNION ALL
    SELECT subject, sample, NULL, NULL, NULL, NULL, count(*) FROM known_sites GROUP BY ALL)
  SELECT subject, sample, max(a) AS n_registered, max(b) AS n_sheet_rows, max(c) AS n_fragments, max(d) AS n_clusters, max(e) AS n_sites FROM u WHERE subject IS NOT NULL AND sample IS NOT NULL GROUP BY ALL""",
    "subject_history_merge": f"""WITH r AS (SELECT {_SAMPLE}, replicate, ref_genome, mode, batch > 0 AS incoming, max(sample_id) AS sample_id FROM samples
    WHERE trial IS NOT NULL AND subject IS NOT NULL AND sample IS NOT NULL AND replicate IS NOT NULL AND ref_genome IS NOT NULL AND mode IS NOT NULL GROUP BY ALL)
  SELECT {_SAMPLE}, replicate, ref_genome, mode, sample_id, CASE WHEN incoming THEN 'incoming' ELSE 'archive' END AS origin FROM r
  QUALIFY row_number() OVER (PARTITION BY {_SAMPLE}, replicate, ref_genome, mode ORDER BY incoming DESC) = 1""",
    "scope_replace": f"""WITH r AS (SELECT {_SCOPE}, posid, replicate, nreads FROM buildstdfragments),
  g AS (SELECT DISTINCT {_SAMPLE}, refgenome FROM r WHERE replicate >= 3),
  x AS (SELECT *, 'kept' AS state FROM r WHERE replicate < 3 AND ({_SAMPLE}, refgenome) NOT IN (SELECT ({_SAMPLE}, refgenome) FROM g) UNION ALL SELECT *, 'new' FROM r WHERE replicate >= 3 AND nreads > 1)
  SELECT {_SCOPE}, state, count(*) AS n, CAST(sum(nreads) AS BIGINT) AS reads FROM x GROUP BY ALL""",
    "truth_recovery": f"""WITH {_SITES}, t AS (SELECT chrom, strand, pos AS true_pos, count(*) AS n_rows FROM known GROUP BY ALL),
  o AS (SELECT chrom, strand, pos AS site_pos, CAST(sum(nreads) AS BIGINT) AS site_reads FROM (SELECT {_spot("posid")}, nreads FROM buildstdfragments WHERE posid IS NOT NULL) GROUP BY ALL)
  SELECT t.chrom, t.strand, true_pos, n_rows, site_pos, abs(true_pos - site_pos) AS distance, site_reads FROM t LEFT JOIN o ON t.chrom = o.chrom AND t.strand = o.strand AND abs(true_pos - site_pos) <= 5
  QUALIFY row_number() OVER (PARTITION BY t.chrom, t.strand, true_pos ORDER BY abs(true_pos - site_pos), site_reads DESC, site_pos) = 1""",
    "spacing_stats": f"""WITH {_SPOTS}, g AS (SELECT chrom, lead(pos) OVER (PARTITION BY chrom ORDER BY pos) - pos AS gap FROM spots)
  SELECT chrom, count(*) AS n, min(gap) AS min_gap, max(gap) AS max_gap, round(avg(gap), 4) AS mean_gap, median(gap) AS median_gap FROM g WHERE gap IS NOT NULL GROUP BY 1""",
    "catalog_counts": f"""WITH c AS (SELECT *, {_strip("clusterid")} AS cluster FROM buildstdfragments)
  SELECT {_SCOPE}, count(DISTINCT (fragchromosome, fragstrand, fragstart, fragend)) AS total_fragments, count(DISTINCT posid) AS total_sites, count(DISTINCT CASE WHEN cluster NOT IN ('', 'NA') THEN cluster END) AS total_clusters FROM c GROUP BY ALL""",
    "index_orientation": """WITH b AS (SELECT DISTINCT upper(index1seq) AS s FROM sampledata),
  x AS (SELECT count(*) FILTER (WHERE umi IN (SELECT s FROM b)) AS n_forward, count(*) FILTER (WHERE reverse(translate(umi, 'ACGTN', 'TGCAN')) IN (SELECT s FROM b)) AS n_reverse FROM buildstdfragments)
  SELECT *, n_reverse > n_forward AS reverse FROM x""",
    "site_umi_counts": f"SELECT {_SITE}, CASE WHEN (SELECT bool_or(umi <> 'AAAAAAAAAAAA') FROM buildstdfragments) THEN count(DISTINCT umi) END AS n_umis FROM buildstdfragments WHERE posid IS NOT NULL GROUP BY ALL",
    "header_fill_down": "SELECT line_id, sheet, CAST(last_value(CASE WHEN line_no = 1 THEN line_no END IGNORE NULLS) OVER (PARTITION BY sheet ORDER BY line_no) AS BIGINT) AS header_no FROM sampledata_lines",
    "golay_decode": f"""WITH b AS (SELECT upper(index1seq) AS barcode, count(*) AS n FROM sampledata GROUP BY 1),
  v AS (SELECT *, CASE WHEN regexp_full_match(barcode, '[ACGTN]{{12}}') THEN list_sum(list_transform(range(12), lambda k: (CASE substr(barcode, CAST(k AS INTEGER) + 1, 1) WHEN 'C' THEN 0 WHEN 'T' THEN 1 WHEN 'G' THEN 2 ELSE 3 END) << (2 * k)))::BIGINT END AS w FROM b),
  m AS (SELECT x << 12 | list_reduce(list_transform(range(12), lambda j: CASE WHEN x >> j & 1 = 1 THEN {_PARITY}[j + 1] ELSE 0 END), lambda p, q: xor(p, q))::BIGINT AS word FROM (SELECT unnest(range(4096)) AS x)),
  d AS (SELECT barcode, word FROM v JOIN m ON bit_count(xor(v.w, m.word)) <= 3)
  SELECT barcode, n, CASE WHEN word IS NOT NULL THEN list_aggregate(list_transform(range(12), lambda k: substr('CTGA', CAST(1 + (word >> (2 * k) & 3) AS INTEGER), 1)), 'string_agg', '') END AS corrected FROM b LEFT JOIN d USING (barcode)""",
    "quality_trim": """WITH r AS (SELECT readid, min(repleaderseq) AS seq FROM buildstdfragments WHERE repleaderseq IS NOT NULL GROUP BY 1),
  q AS (SELECT *, length(seq) AS n, substr(translate(md5(readid), '0123456789abcdef', '#%'')+-/13579;=?A') || md5(seq), 1, length(seq)) AS quality FROM r),
  l AS (SELECT *, list_transform(range(1, n + 1), lambda i: CASE WHEN ascii(substr(quality, CAST(i AS INTEGER), 1)) <= 43 THEN 1 ELSE 0 END) AS low FROM q),
  k AS (SELECT *, coalesce(list_filter(range(1, n + 1), lambda i: list_sum(list_transform(range(-3, 4), lambda o: low[greatest(1, least(n, i + o))])) >= 2)[1] - 1, n) AS keep FROM l)
  SELECT readid, substr(seq, 1, CAST(keep AS INTEGER)) AS seq, substr(quality, 1, CAST(keep AS INTEGER)) AS quality FROM k""",
}
