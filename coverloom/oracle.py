"""DuckDB SQL of the registered queries."""

from __future__ import annotations

from coverloom.adapters import with_views

_IDS = "array_to_string(list_sort(list_transform(ids, lambda x: x::VARCHAR)), ',') AS target_ids"
_APPRAISED = "WITH app AS (SELECT o.*, q.divergence, string_agg(q.genome, ',' ORDER BY q.genome) AS found_in FROM query_hits q JOIN {otu} o ON o.gene = q.marker AND o.sample = q.query_name AND o.sequence = q.query_sequence GROUP BY ALL)"
_OTU = "gene, sample, sequence, num_hits, coverage, taxonomy"
_NEAR = "near AS (SELECT query_name AS a, match_name AS b, jaccard FROM distances UNION ALL SELECT match_name, query_name, jaccard FROM distances)"
#: Neighbours of every sample: (sample, b, k), k = 1 for the most similar; all other samples fill up.
_RANKED = _NEAR + ", names AS (SELECT DISTINCT a AS sample FROM near), ranked AS (SELECT n.sample, m.sample AS b, row_number() OVER (PARTITION BY n.sample ORDER BY coalesce(jaccard, 0) DESC, m.sample DESC) AS k FROM names n JOIN names m ON n.sample <> m.sample LEFT JOIN near ON near.a = n.sample AND near.b = m.sample)"
#: Sets of 2 and 3 from three neighbours, least similar first, the first four combinations of each size.
_SETS3 = _RANKED + ", trio AS (SELECT sample, list(b ORDER BY k DESC) AS x FROM ranked WHERE k <= 3 GROUP BY sample), sets AS (SELECT DISTINCT array_to_string(list_sort([sample] || list_transform(c, lambda i: x[i])), ',') AS samples FROM trio, (SELECT unnest([[1], [2], [3], [1, 2], [1, 3], [2, 3]]) AS c))"
_SETS2 = _RANKED + ", trio AS (SELECT sample, list(b ORDER BY k DESC) AS x FROM ranked WHERE k <= 3 GROUP BY sample), sets AS (SELECT DISTINCT list_sort([sample, x[i]]) AS s FROM trio, range(1, 4) AS r(i))"
_WEIGHTS = "total AS (SELECT sample, gene, sum(coverage) AS total FROM (SELECT sample, gene, coverage FROM binned UNION ALL SELECT sample, gene, coverage FROM unbinned) {where} GROUP BY ALL), weights AS (SELECT k.gene, k.sequence, avg(coalesce(u.coverage, 0) / total) AS weight FROM (SELECT DISTINCT gene, sequence FROM unbinned) k JOIN total t ON t.gene = k.gene LEFT JOIN unbinned u ON u.sample = t.sample AND u.gene = k.gene AND u.sequence = k.sequence GROUP BY ALL HAVING avg(coalesce(u.coverage, 0) / total) > 0)"
_CAND = "cand AS (SELECT s1 || ',' || s2 AS samples, s1, s2, ids FROM pairs)"
_TRIPLES = "triples AS (SELECT array_to_string([samples[i], samples[j], samples[k]], ',') AS samples, count(*)::INT AS pools, sum(len(ids))::INT AS n_targets FROM pools, range(1, 200) AS x(i), range(1, 200) AS y(j), range(1, 200) AS z(k) WHERE i < j AND j < k AND k <= len(samples) GROUP BY ALL)"
_SCORED = _CAND + ", scored AS (SELECT c.samples, s1, s2, ids, 2 AS length, len(ids)::DOUBLE AS total_targets, (coalesce(a.read_size, 0) + coalesce(b.read_size, 0))::BIGINT AS total_size FROM cand c LEFT JOIN read_size a ON a.sample = s1 LEFT JOIN read_size b ON b.sample = s2)"


def _walk(scored: str, chosen: str) -> str:
    """The greedy choice among the pairs of one CTE, as another."""
    return f"""{chosen}_lined AS (
  SELECT *, row_number() OVER (ORDER BY total_targets DESC, total_size, samples) AS i FROM {scored}
), {chosen}_walk AS (
  SELECT 0::BIGINT AS i, []::VARCHAR[] AS used, NULL::VARCHAR AS took
  UNION ALL
  SELECT l.i, CASE WHEN list_contains(used, s1) OR list_contains(used, s2) THEN used ELSE used || [s1, s2] END,
         CASE WHEN list_contains(used, s1) OR list_contains(used, s2) THEN NULL ELSE l.samples END
  FROM {chosen}_walk w JOIN {chosen}_lined l ON l.i = w.i + 1
), {chosen} AS (SELECT s.* FROM {scored} s WHERE samples IN (SELECT took FROM {chosen}_walk))"""


_GREEDY = _SCORED + ", " + _walk("scored", "chosen")
_RECOVER = "has AS (SELECT DISTINCT sample, unnest(ids) AS target FROM (SELECT s1 AS sample, ids FROM pairs UNION ALL SELECT s2, ids FROM pairs)), shared AS (SELECT samples, sample, count(*) AS n FROM (SELECT samples, unnest(ids) AS target FROM {chosen}) c JOIN has USING (target) GROUP BY ALL), top AS (SELECT samples, sample, row_number() OVER (PARTITION BY samples ORDER BY n DESC, sample) AS k FROM shared QUALIFY k <= 6)"
#: Ranked clusters of the chosen pairs.
_FINISHED = "r AS (SELECT c.samples, any_value(total_targets) AS total_targets, any_value(total_size) AS total_size, string_split(c.samples, ',') || list_filter(list(sample ORDER BY k), lambda s: NOT list_contains(string_split(c.samples, ','), s)) AS rec FROM {chosen} c JOIN top USING (samples) GROUP BY c.samples) SELECT samples, 2 AS length, {total} AS total_targets, total_size, array_to_string(list_sort(rec[1:6]), ',') AS recover_samples, 'coassembly_' || (row_number() OVER (ORDER BY total_targets DESC, total_size, samples DESC) - 1) AS coassembly FROM r"
_HAY = """member AS (SELECT coassembly, unnest(string_split(samples, ',')) AS sample FROM groups
), edge AS (
  SELECT g.coassembly, p.s1, p.s2, p.ids FROM pairs p JOIN member g ON g.sample = p.s1 JOIN member h ON h.sample = p.s2 AND h.coassembly = g.coassembly
), link AS (
  SELECT DISTINCT coassembly, target, unnest([s1, s2]) AS sample FROM (SELECT coassembly, s1, s2, unnest(ids) AS target FROM edge)
), sought AS (
  SELECT gene, sequence, coassembly, taxonomy, NULL::VARCHAR AS found_in, target::VARCHAR AS target, string_agg(sample, ',' ORDER BY sample) AS source_samples, sum(num_hits)::BIGINT AS source_num_hits, sum(coverage) AS source_coverage
  FROM targets JOIN link USING (target, sample) GROUP BY gene, sequence, coassembly, taxonomy, target
), other AS (
  SELECT gene, sequence, coassembly, min(taxonomy) AS taxonomy, min(found_in) AS found_in, min(target) AS target, string_agg(DISTINCT sample, ',' ORDER BY sample) AS source_samples, sum(num_hits)::BIGINT AS source_num_hits, sum(coverage) AS source_coverage
  FROM (SELECT gene, sample, sequence, taxonomy, found_in, num_hits, coverage, NULL::VARCHAR AS target FROM binned
        UNION ALL SELECT gene, sample, sequence, taxonomy, NULL, num_hits, coverage, 'None' FROM targets t WHERE NOT EXISTS (SELECT 1 FROM sought s WHERE s.gene = t.gene AND s.sequence = t.sequence))
  JOIN member USING (sample) GROUP BY gene, sequence, coassembly
), hay AS (SELECT * FROM sought UNION ALL SELECT * FROM other
), hits AS (
  SELECT coassembly, gene, sequence, genome, target, found_in, source_samples, source_num_hits, source_coverage, coalesce(r.taxonomy, h.taxonomy) AS taxonomy
  FROM recovered r FULL JOIN hay h USING (coassembly, gene, sequence)
  WHERE coassembly IN (SELECT coassembly FROM recovered) AND (genome IS NOT NULL OR target IS NOT NULL)
), matched AS (
  SELECT * REPLACE (nullif(target, 'None') AS target) FROM hits WHERE target IS NOT NULL OR found_in IS NOT NULL OR source_samples IS NOT NULL
)"""
_EVAL = ("unbinned", "targets", "binned", "pairs", "groups", "recovered")
_PLAN = "plan AS (SELECT coassembly, samples, len(string_split(samples, ','))::INT AS length, 1.0::DOUBLE AS total_targets, (SELECT coalesce(sum(read_size), 0) FROM read_size r WHERE list_contains(string_split(g.samples, ','), r.sample))::BIGINT AS total_size, samples || ',S1,S2' AS recover_samples FROM groups g)"

ORACLE = {
    "appraise_query_binned": with_views(f"{_APPRAISED.format(otu='otu')} SELECT {_OTU}, found_in FROM app WHERE divergence <= (1 - 0.86::DOUBLE) * 60", "otu", "query_hits"),
    "appraise_query_unbinned": with_views(f"{_APPRAISED.format(otu='otu')} SELECT {_OTU}, NULL::VARCHAR AS found_in FROM otu LEFT JOIN app USING ({_OTU}) WHERE NOT coalesce(divergence <= (1 - 0.86::DOUBLE) * 60, false)", "otu", "query_hits"),
    "appraise_no_genomes": with_views("SELECT *, '' AS found_in FROM otu WHERE gene <> 'Brand#3'", "otu"),
    "appraise_by_sample_binned": with_views(f"{_APPRAISED.format(otu='otu').replace('query_hits', 'some_hits')} SELECT {_OTU}, found_in FROM app WHERE divergence <= (1 - 0.86::DOUBLE) * 60", "otu", "some_hits"),
    "appraise_by_sample_unbinned": with_views(f"{_APPRAISED.format(otu='otu').replace('query_hits', 'some_hits')} SELECT {_OTU}, NULL::VARCHAR AS found_in FROM otu LEFT JOIN app USING ({_OTU}) WHERE sample IN (SELECT query_name FROM some_hits) AND NOT coalesce(divergence <= (1 - 0.86::DOUBLE) * 60, false)", "otu", "some_hits"),
    "appraise_combine": with_views(f"SELECT {_OTU}, found_in FROM binned UNION ALL SELECT {_OTU}, found_in FROM unbinned", "binned", "unbinned"),
    "tables_as_text": with_views(f"SELECT {_OTU} FROM otu", "otu"),
    "appraise_update_union": with_views(f"{_APPRAISED.format(otu='unbinned')[:-1].replace('o.*', 'o.gene, o.sample, o.sequence, o.num_hits, o.coverage, o.taxonomy')}) SELECT * FROM binned UNION ALL SELECT {_OTU}, found_in FROM app WHERE divergence <= (1 - 0.86::DOUBLE) * 60", "otu", "query_hits", "binned", "unbinned"),
    "bad_marker_filter": with_views("SELECT * FROM otu WHERE NOT contains(concat_ws(chr(9), gene, sample, sequence, num_hits, coverage, taxonomy), 'Brand#2')", "otu"),
    "sample_rename": with_views("SELECT gene, sample, sequence FROM otu", "otu"),
    "targets_dense": with_views(f"SELECT {_OTU}, target FROM targets", "targets"),
    "targets_in_file_order": with_views("SELECT gene, sequence, row_number() OVER (ORDER BY substr(sequence, 2)::BIGINT DESC, gene, sequence) - 1 AS target, count(*) AS n FROM unbinned GROUP BY gene, sequence", "unbinned"),
    "targets_taxa_filter": with_views("SELECT taxonomy, count(*) AS n, count(DISTINCT (gene, sequence)) AS n_targets FROM otu WHERE regexp_matches(taxonomy, 'd__ECONOMY|d__PROMO') GROUP BY taxonomy", "otu"),
    "targets_hashed_groups": with_views("SELECT gene, sequence, 1::BIGINT AS n_sequences, count(*) AS n_rows FROM unbinned GROUP BY gene, sequence", "unbinned"),
    "edges_match_pairs": with_views(f"SELECT 'match' AS style, 2 AS cluster_size, s1 || ',' || s2 AS samples, {_IDS} FROM pairs", "pairs"),
    "edges_match_blocks": with_views(f"SELECT 'match' AS style, 2 AS cluster_size, s1 || ',' || s2 AS samples, {_IDS} FROM pairs", "pairs"),
    "edges_pool": with_views(f"SELECT 'pool' AS style, n AS cluster_size, array_to_string(samples, ',') AS samples, {_IDS} FROM pools", "pools"),
    "edges_pool_sizes": with_views(f"WITH p AS (SELECT target, n, list_sort(list(sample)) AS samples FROM targets, (VALUES (3), (4)) AS v(n) WHERE coverage > 90.0 / n GROUP BY target, n), g AS (SELECT n, samples, list(target) AS ids FROM p WHERE len(samples) >= n GROUP BY n, samples) SELECT 'pool' AS style, n AS cluster_size, array_to_string(samples, ',') AS samples, {_IDS} FROM g", "targets"),
    "edges_single_directional": with_views(f"SELECT 'directional' AS style, 2 AS cluster_size, a || ',' || b AS samples, {_IDS} FROM (SELECT s.sample AS a, d.sample AS b, list(DISTINCT s.target) AS ids FROM targets s JOIN targets d ON s.target = d.target AND s.sample <> d.sample WHERE s.coverage > 90 GROUP BY ALL)", "targets"),
    "edges_single_blocks": with_views(f"SELECT 'directional' AS style, 2 AS cluster_size, a || ',' || b AS samples, {_IDS} FROM (SELECT s.sample AS a, d.sample AS b, list(DISTINCT s.target) AS ids FROM targets s JOIN targets d ON s.target = d.target AND s.sample <> d.sample WHERE s.coverage > 90 GROUP BY ALL)", "targets"),
    "edges_single_singleton": with_views(f"WITH t AS (SELECT f.*, d.target FROM fine f JOIN (SELECT sequence, row_number() OVER (ORDER BY sequence) - 1 AS target FROM (SELECT DISTINCT sequence FROM fine)) d USING (sequence)) SELECT 'singleton' AS style, 1 AS cluster_size, sample AS samples, {_IDS} FROM (SELECT sample, list(target) AS ids FROM t WHERE coverage > 10 AND target IN (SELECT target FROM t GROUP BY target HAVING count(DISTINCT sample) = 1) GROUP BY sample)", "fine"),
    "kmer_sketch": with_views("""
WITH d AS (
  SELECT DISTINCT sample, substr(sequence, 2)::BIGINT AS p FROM otu
), s AS (
  SELECT sample, array_to_string(list_transform(range(23, -1, -1), lambda i: ['A', 'C', 'G', 'T'][((p // (4 ** i)::BIGINT) % 4) + 1]), '') AS q FROM d
), k AS (
  SELECT sample, substr(q, i, 12) AS f FROM s, range(1, 14) AS r(i)
)
SELECT DISTINCT sample, least(f, translate(reverse(f), 'ACGT', 'TGCA')) AS kmer FROM k""", "otu"),
    "jaccard_pairs": with_views("WITH k AS (SELECT DISTINCT sample, sequence FROM otu), n AS (SELECT sample, count(*) AS n FROM k GROUP BY sample), i AS (SELECT a.sample AS x, b.sample AS y, count(*) AS c FROM k a JOIN k b ON a.sequence = b.sequence AND a.sample < b.sample GROUP BY ALL) SELECT x AS query_name, y AS match_name, c / (p.n + q.n - c) AS jaccard FROM i JOIN n p ON p.sample = x JOIN n q ON q.sample = y", "otu"),
    "jaccard_filter": with_views("SELECT * FROM distances", "distances"),
    "precluster_topk": with_views(f"WITH {_RANKED} SELECT sample, string_agg(b, ',' ORDER BY k DESC) AS nearest FROM ranked WHERE k <= 4 GROUP BY sample", "distances"),
    "precluster_combinations": with_views(f"WITH {_SETS3} SELECT samples FROM sets", "distances"),
    "edges_preclustered_match": with_views(f"WITH {_SETS3}, m AS (SELECT samples, unnest(string_split(samples, ',')) AS sample, len(string_split(samples, ','))::INT AS n FROM sets), per AS (SELECT samples, n, target FROM m JOIN targets USING (sample) GROUP BY ALL HAVING count(*) = n AND sum(coverage) > 90), g AS (SELECT samples, n, list(target) AS ids FROM per GROUP BY ALL) SELECT 'match' AS style, n AS cluster_size, samples, {_IDS} FROM g", "distances", "targets"),
    "edges_preclustered_single": with_views(f"WITH {_SETS2}, p AS (SELECT s[1] AS a, s[2] AS b FROM sets UNION ALL SELECT s[2], s[1] FROM sets), shared AS (SELECT DISTINCT a, b, x.target FROM p JOIN targets x ON x.sample = a AND x.coverage > 90 JOIN targets y ON y.sample = b AND y.target = x.target), lone AS (SELECT sample, target FROM targets t WHERE coverage > 90 AND NOT EXISTS (SELECT 1 FROM shared s WHERE s.a = t.sample AND s.target = t.target)), e AS (SELECT 'directional' AS style, 2 AS cluster_size, a || ',' || b AS samples, list(target) AS ids FROM shared GROUP BY a, b UNION ALL SELECT 'singleton', 1, sample, list(DISTINCT target) FROM lone GROUP BY sample) SELECT style, cluster_size, samples, {_IDS} FROM e", "distances", "targets"),
    "abundance_weighting": with_views(f"WITH {_WEIGHTS.format(where='')} SELECT gene, sequence, round(weight, 9) AS weight FROM weights", "binned", "unbinned"),
    "abundance_weighting_restricted": with_views("WITH " + _WEIGHTS.format(where="WHERE sample IN ('S1', 'S2', 'S3', 'S5', 'S8')") + " SELECT gene, sequence, round(weight, 9) AS weight FROM weights", "binned", "unbinned"),
    "target_weighting": with_views(f"WITH {_WEIGHTS.format(where='')} SELECT target, round(weight, 9) AS weight FROM (SELECT DISTINCT gene, sequence, target FROM targets) JOIN weights USING (gene, sequence)", "binned", "unbinned", "targets"),
    "cluster_candidates_match": with_views(f"WITH {_CAND} SELECT samples, len(ids)::INT AS n_targets FROM cand", "pairs"),
    "cluster_least_targets": with_views(f"WITH {_CAND} SELECT samples, len(ids)::INT AS n_targets FROM cand WHERE len(ids) >= (SELECT CASE WHEN count(*) > 4000 THEN 10 ELSE 1 END FROM cand)", "pairs"),
    "cluster_candidates_pool": with_views(f"WITH {_TRIPLES} SELECT samples, n_targets FROM triples", "pools"),
    "cluster_candidates_pool_least": with_views(f"WITH {_TRIPLES} SELECT samples, n_targets FROM triples WHERE n_targets >= 3", "pools"),
    "cluster_candidates_single": with_views("WITH s AS (SELECT x.sample, x.target FROM targets x WHERE x.coverage > 90) SELECT sample AS samples, count(DISTINCT target)::INT AS n_targets FROM s GROUP BY sample", "targets"),
    "cluster_restrict_samples": with_views("WITH r AS (SELECT list_filter(samples, lambda s: list_contains(list_transform(range(1, 41), lambda i: 'S' || i), s)) AS x, n, ids FROM pools) SELECT array_to_string(x, ',') AS samples, n AS cluster_size, len(ids)::INT AS n_targets FROM r WHERE len(x) >= n", "pools"),
    "cluster_exclude": with_views(f"WITH {_CAND} SELECT samples FROM cand WHERE samples NOT IN ('S1,S2', 'S3,S4', 'S10,S9')", "pairs"),
    "cluster_anchor": with_views(f"WITH {_CAND} SELECT samples FROM cand WHERE s1 IN ('S7', 'S11') OR s2 IN ('S7', 'S11')", "pairs"),
    "cluster_size_score": with_views(f"WITH {_SCORED} SELECT samples, length, total_targets, total_size FROM scored WHERE total_size <= 9e6", "pairs", "read_size"),
    "cluster_weighted_score": with_views(f"WITH {_WEIGHTS.format(where='')}, w AS (SELECT target, weight FROM (SELECT DISTINCT gene, sequence, target FROM targets) JOIN weights USING (gene, sequence)), {_CAND} SELECT samples, round(sum(coalesce(weight, 0)), 6) AS total_targets FROM (SELECT samples, unnest(ids) AS target FROM cand) LEFT JOIN w USING (target) GROUP BY samples", "binned", "unbinned", "targets", "pairs"),
    "cluster_greedy": with_views(f"WITH {_GREEDY} SELECT samples, length, total_targets, total_size FROM chosen", "pairs", "read_size", recursive=True),
    "cluster_greedy_rounds": with_views(f"WITH {_GREEDY} SELECT samples, length, total_targets, total_size FROM chosen", "pairs", "read_size", recursive=True),
    "cluster_greedy_prefixes": with_views(f"WITH {_GREEDY} SELECT samples, length, total_targets, total_size FROM chosen", "pairs", "read_size", recursive=True),
    "cluster_extra_targets": with_views("WITH small AS (SELECT array_to_string([samples[i], samples[j], samples[k]], ',') AS key, [samples[i], samples[j], samples[k]] AS x, ids FROM pools, range(1, 10) AS a(i), range(1, 10) AS b(j), range(1, 10) AS c(k) WHERE len(samples) <= 9 AND i < j AND j < k AND k <= len(samples)), own AS (SELECT key, any_value(x) AS x, flatten(list(ids)) AS ids FROM small GROUP BY key), m AS (SELECT key, unnest(x) AS s FROM own), b AS (SELECT row_number() OVER () AS pool, samples, ids FROM pools WHERE len(samples) > 9), e AS (SELECT pool, unnest(samples) AS s FROM b), met AS (SELECT key, pool FROM m JOIN e USING (s) GROUP BY key, pool HAVING count(*) = 3), extra AS (SELECT key, unnest(ids) AS t FROM met JOIN b USING (pool) UNION SELECT key, unnest(ids) FROM own) SELECT key AS samples, count(DISTINCT t)::INT AS n_targets FROM extra GROUP BY key", "pools"),
    "recover_candidates_topk": with_views(f"WITH {_CAND}, {_RECOVER.format(chosen='cand')} SELECT samples, string_agg(sample, ',' ORDER BY k) AS recover_candidates FROM top GROUP BY samples", "pairs"),
    "recover_candidates_bounded": with_views(f"WITH {_CAND}, {_RECOVER.format(chosen='cand')} SELECT samples, string_agg(sample, ',' ORDER BY k) AS recover_candidates FROM top GROUP BY samples", "pairs"),
    "elusive_clusters": with_views(f"WITH {_GREEDY}, {_RECOVER.format(chosen='chosen')}, {_FINISHED.format(chosen='chosen', total='total_targets')}", "pairs", "read_size", recursive=True),
    "plan_weighted": with_views(f"WITH {_WEIGHTS.format(where='')}, w AS (SELECT target, weight FROM (SELECT DISTINCT gene, sequence, target FROM targets) JOIN weights USING (gene, sequence)), {_SCORED}, sums AS (SELECT samples, sum(coalesce(weight, 0)) AS total FROM (SELECT samples, unnest(ids) AS target FROM cand) LEFT JOIN w USING (target) GROUP BY samples), weighed AS (SELECT s.* REPLACE (total AS total_targets) FROM scored s JOIN sums USING (samples)), {_walk('weighed', 'chosen')}, {_RECOVER.format(chosen='chosen')}, {_FINISHED.format(chosen='chosen', total='round(total_targets, 6)')}", "binned", "unbinned", "targets", "pairs", "read_size", recursive=True),
    "plan_iterate": with_views(f"WITH {_GREEDY}, left_over AS (SELECT * FROM scored WHERE samples NOT IN (SELECT samples FROM chosen)), {_walk('left_over', 'again')}, {_RECOVER.format(chosen='again')}, {_FINISHED.format(chosen='again', total='total_targets')}", "pairs", "read_size", recursive=True),
    "plan_given_distances": with_views(f"WITH {_SETS2}, got AS (SELECT array_to_string(s, ',') AS samples, s[1] AS s1, s[2] AS s2, list(x.target) AS ids FROM sets JOIN targets x ON x.sample = s[1] JOIN targets y ON y.sample = s[2] AND y.target = x.target WHERE x.coverage + y.coverage > 90 GROUP BY ALL), {_SCORED.replace('FROM pairs)', 'FROM got)', 1)}, {_walk('scored', 'chosen')}, {_RECOVER.replace('FROM pairs', 'FROM got').format(chosen='chosen')}, {_FINISHED.format(chosen='chosen', total='total_targets')}", "distances", "targets", "read_size", recursive=True),
    "plan_single": with_views("WITH cov AS (SELECT sample, target FROM targets WHERE coverage > 90), edge AS (SELECT DISTINCT d.sample AS candidate, d.target FROM targets d JOIN cov s ON s.target = d.target AND s.sample <> d.sample), shared AS (SELECT c.sample AS samples, candidate, count(*) AS n FROM cov c LEFT JOIN edge e ON e.target = c.target GROUP BY ALL), top AS (SELECT *, row_number() OVER (PARTITION BY samples ORDER BY n DESC, candidate NULLS LAST) AS k FROM shared QUALIFY k <= 6), r AS (SELECT samples, [samples] || list_filter(list(candidate ORDER BY k), lambda x: x IS DISTINCT FROM samples) AS rec FROM top GROUP BY samples) SELECT samples, 1 AS length, (SELECT count(*) FROM cov c WHERE c.sample = r.samples)::DOUBLE AS total_targets, coalesce(read_size, 0)::BIGINT AS total_size, array_to_string(list_sort(rec[1:6]), ',') AS recover_samples, samples AS coassembly FROM r LEFT JOIN read_size z ON z.sample = r.samples", "targets", "read_size"),
    "plan_update": with_views(f"WITH {_PLAN} SELECT coassembly, samples, total_size, array_to_string(list_sort(list_distinct(list_filter(string_split(recover_samples, ','), lambda s: s NOT IN ('S2', 'S6')))), ',') AS recover_samples FROM plan WHERE coassembly IN ('coassembly_0', 'coassembly_3', 'coassembly_4') AND NOT list_has_any(string_split(samples, ','), ['S2', 'S6'])", "groups", "read_size"),
    "coassembly_summary": with_views(f"WITH {_PLAN} SELECT coassembly, samples, length, total_targets, total_size, (2 * total_size)::BIGINT AS unmapped_size FROM plan", "groups", "read_size"),
    "cluster_length_histogram": with_views("SELECT len(string_split(samples, ','))::INT AS length, count(*) AS clusters FROM groups GROUP BY 1", "groups"),
    "unused_samples": with_views("SELECT DISTINCT sample FROM otu WHERE sample NOT IN (SELECT unnest([a.sample, b.sample]) FROM targets a JOIN targets b ON a.target = b.target AND a.sample < b.sample WHERE a.coverage + b.coverage > 200)", "otu", "targets"),
    "reference_bins_trimmed_mean": with_views("WITH share AS (SELECT sample, sum(CASE WHEN b THEN num_hits ELSE 0 END) AS x, sum(num_hits) AS y FROM (SELECT sample, num_hits, true AS b FROM binned UNION ALL SELECT sample, num_hits, false FROM unbinned) GROUP BY sample), c AS (SELECT sample, gene, regexp_replace(g, '_protein$', '') AS genome, sum(coverage) AS coverage FROM (SELECT sample, gene, unnest(string_split(found_in, ',')) AS g, coverage FROM binned WHERE sample IN (SELECT sample FROM share WHERE x >= 0.1 * y)) GROUP BY ALL), grid AS (SELECT s.sample, s.gene, m.genome, coalesce(c.coverage, 0) AS coverage FROM (SELECT DISTINCT sample, gene FROM c) s JOIN (SELECT DISTINCT sample, genome FROM c) m ON m.sample = s.sample LEFT JOIN c ON c.sample = s.sample AND c.gene = s.gene AND c.genome = m.genome), l AS (SELECT sample, genome, list_sort(list(coverage)) AS v, floor(count(*) * 0.1::DOUBLE)::INT AS k FROM grid GROUP BY ALL) SELECT sample, genome FROM l WHERE list_avg(v[k + 1:len(v) - k]) > 0", "binned", "unbinned"),
    "evaluate_matched": with_views(f"WITH {_HAY} SELECT * FROM matched", *_EVAL),
    "evaluate_novel": with_views(f"WITH {_HAY} SELECT coassembly, gene, sequence, genome, taxonomy FROM hits WHERE target IS NULL AND found_in IS NULL AND source_samples IS NULL", *_EVAL),
    "evaluate_summary_stats": with_views(f"""WITH {_HAY}, t AS (
  SELECT coassembly, CASE WHEN genome IS NOT NULL THEN 'match' ELSE 'nonmatch' END AS status, count(DISTINCT sequence) AS sequences, count(DISTINCT genome) AS bins, count(DISTINCT taxonomy) AS taxonomy
  FROM matched WHERE target IS NOT NULL GROUP BY ALL
), f AS (SELECT * REPLACE (nullif(target, 'None') AS target) FROM hits WHERE genome IS NOT NULL
), u AS (
  SELECT coassembly, status, 'sequences' AS statistic, sequences AS value FROM t UNION ALL SELECT coassembly, status, 'bins', bins FROM t UNION ALL SELECT coassembly, status, 'taxonomy', taxonomy FROM t
  UNION ALL SELECT coassembly, CASE WHEN found_in IS NOT NULL THEN 'match' ELSE 'nonmatch' END, 'nontarget_bin_sequences', count(*) FROM f GROUP BY ALL
  UNION ALL SELECT coassembly, CASE WHEN target IS NULL AND found_in IS NULL AND source_samples IS NOT NULL THEN 'match' ELSE 'nonmatch' END, 'nontarget_unbin_sequences', count(*) FROM f GROUP BY ALL
  UNION ALL SELECT coassembly, CASE WHEN target IS NULL AND found_in IS NULL AND source_samples IS NULL THEN 'match' ELSE 'nonmatch' END, 'novel_sequences', count(*) FROM f GROUP BY ALL
), st AS (SELECT DISTINCT coassembly, status FROM u
), dense AS (
  SELECT s.coassembly, s.status, k.statistic, coalesce(u.value, 0) AS value FROM st s, (SELECT unnest(['sequences', 'bins', 'taxonomy', 'nontarget_bin_sequences', 'nontarget_unbin_sequences', 'novel_sequences']) AS statistic) k LEFT JOIN u ON u.coassembly = s.coassembly AND u.status = s.status AND u.statistic = k.statistic
), nb AS (SELECT coassembly, count(DISTINCT genome) AS n FROM recovered GROUP BY coassembly
), fixed AS (
  SELECT * FROM dense WHERE NOT (statistic = 'bins' AND status = 'nonmatch')
  UNION ALL SELECT nb.coassembly, 'nonmatch', 'bins', n - d.value FROM nb LEFT JOIN dense d ON d.coassembly = nb.coassembly AND d.status = 'match' AND d.statistic = 'bins'
), wide AS (SELECT coassembly, statistic, max(value) FILTER (status = 'match') AS match, max(value) FILTER (status = 'nonmatch') AS nonmatch FROM fixed GROUP BY ALL)
SELECT coassembly, statistic, CASE WHEN statistic IN ('sequences', 'taxonomy') THEN 'targets' ELSE 'recovery' END AS within, match, nonmatch, match + nonmatch AS total, round(CASE WHEN match + nonmatch <> 0 THEN match / (match + nonmatch) * 100 END, 2) AS match_percent FROM wide""", *_EVAL),
    "evaluate_by_phylum": with_views(f"WITH {_HAY} SELECT string_split(taxonomy, '; ')[2] AS \"group\", count(genome) AS recovered, count(*) - count(genome) AS missed FROM matched WHERE target IS NOT NULL GROUP BY 1", *_EVAL),
    "evaluate_by_gene": with_views(f"WITH {_HAY} SELECT gene, count(genome) AS recovered, count(*) - count(genome) AS missed FROM matched WHERE target IS NOT NULL GROUP BY 1", *_EVAL),
    "evaluate_wide_table": None,
    "command_rendering": with_views(f"""WITH {_PLAN}, x AS (SELECT *, string_split(samples, ',') AS s, string_split(recover_samples, ',') AS r, (SELECT list(DISTINCT sample) FROM otu) AS known FROM plan
), f AS (SELECT coassembly, {', '.join(f"array_to_string(list_transform({c}, lambda v: CASE WHEN list_contains(known, v) THEN '/r/' || v || '_{i}.fq' ELSE v END), ' ') AS {c}{i}" for c in 'sr' for i in (1, 2))} FROM x)
SELECT coassembly, 'aviary assemble --coassemble -1 ' || s1 || ' -2 ' || s2 || ' --output out/coassemble/' || coassembly || '/assemble -n 64 -t 64 -m 500 --skip-qc &> out/coassemble/logs/' || coassembly || '_assemble.log ' AS assemble,
  'aviary recover --assembly out/coassemble/' || coassembly || '/assemble/assembly/final_contigs.fasta -1 ' || r1 || ' -2 ' || r2 || ' --output out/coassemble/' || coassembly || '/recover --binning-only --refinery-max-iterations 0 -n 32 -t 32 -m 250 --skip-qc &> out/coassemble/logs/' || coassembly || '_recover.log ' AS recover FROM f""", "groups", "read_size", "otu"),
    "interleave_pairs": with_views("WITH h AS (SELECT sample, (number + 1) // 2 AS i, number % 2 AS r, regexp_extract(read, '^[^ ]*(.*)', 1) AS h FROM reads), p AS (SELECT sample, i, max(h) FILTER (r = 1) AS a, max(h) FILTER (r = 0) AS b FROM h GROUP BY ALL), o AS (SELECT sample, count(*) FILTER (a <> b) AS bad FROM p GROUP BY sample), n AS (SELECT sample, count(*) AS n FROM reads GROUP BY sample) SELECT sample, n % 2 = 0 AND bad = 0 AS interleaved, CASE WHEN n % 2 = 1 THEN 'Odd readcount' WHEN bad > 0 THEN 'Consecutive reads do not match (' || bad || '/' || (n // 2) || ')' ELSE 'Duplicate read names in consecutive reads with even readcount' END AS reason FROM n JOIN o USING (sample)", "reads"),
    "read_file_names": "WITH f AS (SELECT s_suppkey AS k, '/r/' || s_name || CASE s_suppkey % 4 WHEN 0 THEN '_1.fq.gz' WHEN 1 THEN '.1.fastq' WHEN 2 THEN '_R1.fna' ELSE 'R_R1.txt' END AS forward, '/r/' || s_name || CASE s_suppkey % 4 WHEN 0 THEN '_2.fq.gz' WHEN 1 THEN '.2.fastq' WHEN 2 THEN '_R2.fna' ELSE 'R_R2.txt' END AS reverse, s_name AS n FROM supplier) SELECT forward, CASE WHEN k % 3 <> 0 THEN reverse END AS reverse, CASE WHEN k % 3 <> 0 THEN n ELSE n || CASE k % 4 WHEN 0 THEN '_1' WHEN 1 THEN '.1' WHEN 2 THEN '_R1' ELSE 'R_R1.txt' END END AS sample FROM f",
    "interleave_ends": with_views("WITH n AS (SELECT sample, count(*) AS n FROM reads GROUP BY sample), e AS (SELECT r.* FROM reads r JOIN n USING (sample) WHERE number <= 6 OR number > n - 4), p AS (SELECT sample, (number + 1) // 2 AS i, max(regexp_extract('@' || read, '^[^ ]*(.*)', 1)) FILTER (number % 2 = 1) AS a, max(regexp_extract('@' || read, '^[^ ]*(.*)', 1)) FILTER (number % 2 = 0) AS b FROM e GROUP BY ALL), o AS (SELECT sample, count(*) FILTER (a <> b) AS bad FROM p GROUP BY sample), k AS (SELECT sample, count(*) AS k FROM e GROUP BY sample) SELECT sample, n % 2 = 0 AND bad = 0 AS interleaved, CASE WHEN n % 2 = 1 THEN 'Odd readcount' WHEN bad > 0 THEN 'Consecutive reads do not match (' || bad || '/' || (k // 2) || ')' ELSE 'Duplicate read names in consecutive reads with even readcount' END AS reason FROM n JOIN o USING (sample) JOIN k USING (sample)", "reads"),
    "base_pairs_of_files": with_views("SELECT sample, sum(length('ACGT' || number))::BIGINT AS read_size FROM reads GROUP BY sample", "reads"),
    "deinterleave_mates": with_views("SELECT sample, '@' || read AS read, number // 2 AS number FROM reads WHERE number % 2 = 0", "reads"),
    "genome_fasta": "SELECT 'B' || p_size AS bin, '>B' || p_size || '~' || p_name AS value FROM part UNION ALL SELECT 'B' || p_size, p_brand || '>' || p_type FROM part",
    "base_pair_count": with_views("SELECT sample, sum(length(value))::BIGINT AS read_size FROM lines WHERE line_no % 4 = 2 GROUP BY sample", "lines"),
    "single_ended_filter": with_views(f"WITH {_PLAN} SELECT coassembly, samples, array_to_string(list_sort(list_distinct(list_filter(string_split(recover_samples, ','), lambda s: s NOT IN ('S2', 'S5')))), ',') AS recover_samples FROM plan WHERE NOT list_has_any(string_split(samples, ','), ['S2', 'S5'])", "groups", "read_size"),
    "recovery_samples": with_views(f"WITH {_PLAN} SELECT DISTINCT unnest(string_split(recover_samples, ',')) AS sample FROM plan WHERE coassembly IN ('coassembly_0', 'coassembly_3', 'coassembly_4')", "groups", "read_size"),
    "duplicate_suggestions": with_views("SELECT coassembly, samples FROM groups WHERE regexp_matches(coassembly, '[05]$')", "groups"),
    "exclusion_union": with_views("SELECT DISTINCT samples FROM groups WHERE regexp_matches(coassembly, '[0-7]$')", "groups"),
    "bin_quality_filter": with_views("SELECT Name FROM bins WHERE comp >= 70 AND cont <= 10", "bins"),
    "bin_provenance": "SELECT 'coassembly_' || (p_partkey % 9) AS coassembly, lower(substr(p_type, 1, 4)) || '_bin.' || p_partkey AS Name, lower(substr(p_type, 1, 4)) AS binner, 'out/coassemble/coassembly_' || (p_partkey % 9) || '/recover/bins/final_bins/' || lower(substr(p_type, 1, 4)) || '_bin.' || p_partkey || '.fna' AS bin_source, 'recovered_it2_coassembly_' || (p_partkey % 9) || '.' || (p_partkey // 9 + 1) AS new_name, 'out/recovered/bins/recovered_it2_coassembly_' || (p_partkey % 9) || '.' || (p_partkey // 9 + 1) || '.fna' AS bin_dest FROM part",
    "prior_assembly_missing": with_views("SELECT DISTINCT sample AS name FROM otu WHERE sample NOT IN (SELECT 'S' || (c_custkey * 3) FROM customer)", "otu"),
    "prior_assembly_extra": with_views("SELECT 'S' || (c_custkey * 3) AS name FROM customer WHERE 'S' || (c_custkey * 3) NOT IN (SELECT sample FROM otu)", "otu"),
    "completion_report": "WITH d AS (SELECT o_orderpriority AS dir, count(*) AS total, count(*) FILTER (o_orderstatus <> 'O') AS assembled, count(*) FILTER (o_orderstatus = 'F') AS recovered FROM orders GROUP BY 1) SELECT dir, total, assembled, recovered, total - recovered AS incomplete FROM d UNION ALL SELECT count(*)::VARCHAR, sum(total)::BIGINT, sum(assembled)::BIGINT, sum(recovered)::BIGINT, sum(total - recovered)::BIGINT FROM d",
    "completion_of_folders": "WITH d AS (SELECT 'run' || (s_nationkey % 5) AS dir, count(*) AS total, count(*) FILTER (WHERE s_acctbal > 0) AS assembled, count(*) FILTER (WHERE s_acctbal > 5000) AS recovered FROM supplier GROUP BY 1) SELECT dir, total, assembled, recovered, total - recovered AS incomplete FROM d UNION ALL SELECT count(*)::VARCHAR, sum(total)::BIGINT, sum(assembled)::BIGINT, sum(recovered)::BIGINT, sum(total - recovered)::BIGINT FROM d",
    "consecutive_uniq_count": "SELECT count(*) AS clusters FROM (SELECT event_type, lag(event_type) OVER (ORDER BY ts, event_id) AS b, row_number() OVER (ORDER BY ts, event_id) AS i FROM events) WHERE i = 1 OR event_type IS DISTINCT FROM b",
}
ORACLE["evaluate_wide_table"] = with_views(f"WITH {_PLAN}, st AS ({ORACLE['evaluate_summary_stats']}) SELECT p.coassembly, any_value(p.length) AS length, any_value(p.total_size) / 1e9 AS total_size, {', '.join(f'max(match) FILTER (statistic = {n!r}) AS {n}' for n in ('sequences', 'bins', 'nontarget_bin_sequences', 'nontarget_unbin_sequences', 'novel_sequences'))} FROM plan p LEFT JOIN st ON st.coassembly = p.coassembly GROUP BY p.coassembly", "groups", "read_size")
