"""The same results in DuckDB's SQL, written apart from the DataFrame code."""

from __future__ import annotations

WS = r"[\t-\r\x{1c}-\x20\x{85}\p{Z}]"
W = r"[\p{L}\p{N}_]"
FAILURES = "(SELECT DISTINCT ON (failure_id) * FROM failures)"
CALLS = "(SELECT DISTINCT ON (call_id) * FROM output_calls)"
SNAPSHOTS = "(SELECT DISTINCT ON (source_id) * FROM snapshots WHERE source_id IS NOT NULL)"
CHUNKS = "(SELECT DISTINCT ON (source_id, chunk_id) * FROM chunks)"
TARGETS = "(SELECT DISTINCT ON (list_row) * FROM target_list)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


#: DuckDB composes canonically only; these are the characters of the tables that compatibility changes besides: full-width ASCII by its rule, and the ellipsis.
WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)).replace("'", "''")


def nfkc(x: str) -> str:
    return f"nfc_normalize(replace(translate({x}, '{WIDE}', '{NARROW}'), '…', '...'))"


def norm(x: str) -> str:
    x = nfkc(x)
    x = f"translate({x}, '‘’“”‐‑‒–—―−­', '''''\"\"-------')"
    x = rf"regexp_replace({x}, '({W}-){WS}*\n{WS}*({W})', '\1\2', 'g')"
    x = f"regexp_replace({x}, '{WS}+', ' ', 'g')"
    x = rf"regexp_replace(regexp_replace({x}, '({W})-({W})', '\1\2', 'g'), '({W})-({W})', '\1\2', 'g')"
    return strip(x)


def toks(x: str) -> str:
    return f"list_filter(regexp_extract_all(lower({norm(x)}), '[a-z0-9][a-z0-9-]{{2,}}'), lambda t: t NOT IN ('the','and','for','with','from','that','this','are','was','were'))"


SPECIFIC = (
    "NOT regexp_full_match(l, 'p\\.?\\s*\\d+') AND NOT regexp_full_match(l, 'char:\\d+-\\d+') AND (contains(l, ' - ') OR contains(l, '—') OR contains(l, '–') OR "
    "contains(l,'table') OR contains(l,'figure') OR contains(l,'fig.') OR contains(l,'grid') OR contains(l,'chart') OR contains(l,'dashboard') OR contains(l,'matrix') OR contains(l,'caption') OR contains(l,'heading') OR contains(l,'panel') OR contains(l,'view'))"
)
PAGE = "TRY_CAST(nullif(regexp_extract(locator, '(?i)p\\.?\\s*(\\d+)', 1), '') AS INT)"

#: Spans of a quote and where they are in the text of its source.
FOUND = f"""src AS (SELECT source_id, coalesce({norm("coalesce(snapshot_text, '')")}, '') AS txt, scrambled_pages FROM {SNAPSHOTS}),
f AS (SELECT q.*, coalesce(txt, '') AS txt, scrambled_pages, string_split(evidence_quote, ' ... ') AS raw FROM {FAILURES} q LEFT JOIN src USING (source_id)),
s AS (SELECT *, list_filter(list_transform(raw, lambda r: {norm("r")}), lambda r: r <> '') AS sp FROM f),
k AS (SELECT *, len(list_filter(raw, lambda r: len({toks("r")}) < 4)) > 0 AS thin, strpos(txt, sp[1]) AS a FROM s),
m AS (SELECT *, a + length(sp[1]) AS c2 FROM k),
n AS (SELECT *, CASE WHEN a > 0 AND strpos(substr(txt, c2), sp[2]) > 0 THEN c2 + strpos(substr(txt, c2), sp[2]) - 1 ELSE 0 END AS b FROM m),
o AS (SELECT *, CASE WHEN b > 0 THEN strpos(substr(txt, b + length(sp[2])), sp[3]) ELSE 0 END AS c FROM n),
v AS (SELECT *, CASE WHEN coalesce(len(sp), 0) = 0 THEN 'empty' WHEN len(sp) > 3 THEN 'too_many_spans' WHEN len(sp) > 1 AND thin THEN 'span_too_short' WHEN a = 0 THEN 'not_found'
  WHEN len(sp) > 1 AND b = 0 THEN CASE WHEN contains(txt, sp[2]) THEN 'out_of_order' ELSE 'not_found' END
  WHEN len(sp) > 2 AND c = 0 THEN CASE WHEN contains(txt, sp[3]) THEN 'out_of_order' ELSE 'not_found' END ELSE 'found' END AS result FROM o)"""

LEAF = "(SELECT sub_asset_class, leaf_no, asset_class_category, asset_class, canva_groupings FROM taxonomy)"
LEAF_TOKENS = "list_filter(regexp_extract_all(lower(sub_asset_class), '[a-z0-9]+'), lambda t: length(t) >= 2 AND t NOT IN ('of','and','the','inc','for','vs'))"
OVERLAP = f"coalesce(len(list_filter({LEAF_TOKENS}, lambda t: len(list_filter(words, lambda w: t = w OR (length(t) >= 4 AND length(w) >= 4 AND (starts_with(w, t) OR starts_with(t, w))))) > 0)), 0)"
LANG = "['explicit_dial','explicit_stance','directional','implied','none']"
OBSERVED = f"""ob AS (SELECT f.*, t.leaf_no, {LANG}[1 + failure_id % 5] AS call_language, call_view = 'UNCERTAIN' AS conflict, failure_id % 4 <> 0 AS well_read, failure_id % 11 = 0 AS degraded,
  CASE WHEN checker_strength IS NOT NULL THEN ['pass','pass','unclear','fail'][1 + failure_id % 4] END AS supports_view, CASE WHEN checker_strength IS NOT NULL THEN ['pass','pass','pass','pass','fail'][1 + failure_id % 5] END AS forward_looking,
  failure_id % 60 - 30.0 AS delta, failure_id % 2 = 0 AS bp FROM {FAILURES} f LEFT JOIN {LEAF} t USING (sub_asset_class))"""

SQL: dict[str, str] = {
    "source_urls": rf"""WITH a AS (SELECT *, trim(source_link) AS u, regexp_extract(trim(source_link), '[?&]url=([^&#]*)', 1) AS enc FROM {TARGETS}),
b AS (SELECT *, CASE WHEN starts_with(u, 'read://') AND enc <> '' THEN url_decode(enc) WHEN contains(u, 'seismic.com') THEN replace(replace(u, 'PLUSSIGN', '+'), '___', '/') ELSE u END AS x FROM a),
c AS (SELECT *, regexp_extract(x, '\?([^#]*)', 1) AS qs, list_filter(string_split(regexp_extract(x, '\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT starts_with(lower(split_part(p, '=', 1)), 'utm_') AND lower(split_part(p, '=', 1)) NOT IN ('fbclid', 'gclid')) AS ps FROM b),
e AS (SELECT *, CASE WHEN qs = '' THEN x ELSE regexp_extract(x, '^[^?#]*') || CASE WHEN len(ps) > 0 THEN '?' || array_to_string(list_transform(ps, lambda p: url_encode(url_decode(split_part(p, '=', 1))) || '=' || url_encode(url_decode(regexp_extract(p, '=(.*)$', 1)))), '&') ELSE '' END || regexp_extract(x, '#.*$') END AS resolved_url FROM c)
SELECT list_row, coalesce(nullif({strip("id")}, ''), coalesce(nullif(regexp_replace(regexp_replace(lower(concat_ws(' ', list_row::VARCHAR, firm, title)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'source')) AS source_id, resolved_url,
CASE WHEN lower(regexp_replace(regexp_extract(resolved_url, '^[^?#]*'), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', '')) LIKE '%.pdf' THEN 'pdf' ELSE 'html' END AS source_type FROM e""",
    "firm_keys": f"SELECT regexp_replace(lower(firm), '[^a-z0-9]', '', 'g') AS firm_key, count(*) AS n FROM {TARGETS} GROUP BY 1",
    "visual_pages": f"SELECT source_id, coalesce(visual_markup['img'], 0) + coalesce(visual_markup['canvas'], 0) + coalesce(visual_markup['figure'], 0) >= 5 AS visual_heavy FROM {SNAPSHOTS}",
    "made_chunks": f"""WITH p AS (SELECT source_id, page_count AS n, unnest(generate_series(1, page_count, 5)) AS a FROM {SNAPSHOTS} WHERE page_count >= 1),
h AS (SELECT source_id, length(coalesce(snapshot_text, '')) AS n, unnest(generate_series(0, greatest(length(coalesce(snapshot_text, '')) - 1, 0), 8000)) AS a FROM {SNAPSHOTS} WHERE page_count IS NULL)
SELECT source_id, CAST((a - 1) / 5 AS INT) AS chunk_ord, 'p' || a || '-' || least(a + 4, n) AS chunk_id, 'p.' || a || '-' || least(a + 4, n) AS locator FROM p
UNION ALL SELECT source_id, CAST(a / 8000 AS INT), 'char:' || a || '-' || least(a + 8000, n), 'char:' || a || '-' || least(a + 8000, n) FROM h""",
    "chunk_lengths": rf"""WITH a AS (SELECT c.source_id, chunk_id, snapshot_text, TRY_CAST(regexp_extract(chunk_id, '^(?:char:|p)(\d+)-', 1) AS INT) AS x, TRY_CAST(regexp_extract(chunk_id, '-(\d+)$', 1) AS INT) AS y FROM {CHUNKS} c JOIN {SNAPSHOTS} s USING (source_id)),
b AS (SELECT source_id, chunk_id, CASE WHEN chunk_id LIKE 'char:%' THEN substr(snapshot_text, x + 1, y - x) WHEN chunk_id LIKE 'p%' THEN array_to_string(string_split(snapshot_text, chr(12))[x:y], chr(12)) ELSE snapshot_text END AS t FROM a)
SELECT source_id, chunk_id, CAST(length(t) AS INT) AS n_chars, md5(t) AS digest FROM b""",
    "source_batches": f"SELECT list_row, CAST((row_number() OVER (ORDER BY list_row) - 1) // 20 AS INT) AS batch_no FROM {TARGETS}",
    "read_quality": f"""WITH a AS (SELECT source_id, page_count, length({strip("coalesce(snapshot_text, '')")}) AS n FROM {SNAPSHOTS})
SELECT source_id, CASE WHEN page_count IS NULL THEN n >= 1000 ELSE page_count > 0 AND n / nullif(page_count, 0) >= 200 END AS well_read FROM a""",
    "normalized_quotes": f"SELECT failure_id, {norm('evidence_quote')} AS quote FROM {FAILURES}",
    "nfkc_texts": f"SELECT source_id, md5({norm("coalesce(snapshot_text, '')")}) AS digest FROM {SNAPSHOTS}",
    "quote_tokens": f"SELECT failure_id, CAST(coalesce(len({toks('evidence_quote')}), 0) AS INT) AS n, coalesce(array_to_string({toks('evidence_quote')}, ' '), '') AS tokens FROM {FAILURES}",
    "verbatim_evidence": f"WITH {FOUND} SELECT failure_id, result FROM v",
    "evidence_check": f"""WITH {FOUND}, g AS (SELECT *, EXISTS (SELECT 1 FROM chunks c WHERE c.source_id = v.source_id AND c.chunk_id = v.chunk_id) AS known, coalesce(list_distinct({toks('evidence_quote')}), []) AS tk, list_distinct({toks('txt')}) AS st, lower({strip("coalesce(locator, '')")}) AS l, {PAGE} AS page FROM v),
h AS (SELECT *, NOT known OR {strip('txt')} = '' AS blank, coalesce(evidence_kind, 'prose') = 'prose' AS prose, len(tk) > 0 AND len(list_intersect(tk, st)) >= least(2, len(tk)) AS ov FROM g),
i AS (SELECT *, prose AND NOT blank AND coalesce(list_contains(scrambled_pages, page), FALSE) AS deg FROM h),
j AS (SELECT *, CASE WHEN blank THEN 'evidence_check_failed' WHEN deg THEN CASE WHEN NOT ov THEN 'quote_not_found' END WHEN prose THEN CASE WHEN result <> 'found' THEN 'quote_not_found' END
WHEN NOT ({SPECIFIC}) THEN 'visual_locator_missing' WHEN len(tk) = 0 OR NOT ov THEN 'evidence_check_failed' END AS r,
CASE WHEN blank THEN 'snapshot text is empty' WHEN deg THEN CASE WHEN NOT ov THEN 'page p.' || page || ' flagged scrambled (two-column interleave); prose verbatim check degraded to key-token overlap, which also failed' END
WHEN prose THEN CASE result WHEN 'empty' THEN 'prose quote is empty' WHEN 'too_many_spans' THEN 'prose quote has more than 3 spans' WHEN 'span_too_short' THEN 'a prose quote span is too short to verify' WHEN 'out_of_order' THEN 'prose quote spans are out of document order' WHEN 'not_found' THEN 'prose quote was not found' END
WHEN NOT ({SPECIFIC}) THEN 'table/visual evidence needs page plus table, figure, grid, caption, or heading' WHEN len(tk) = 0 THEN 'table/visual evidence is empty' WHEN NOT ov THEN 'table/visual evidence tokens were not found in snapshot text' END AS m FROM i)
SELECT failure_id, r IS NULL AS ev_passed, coalesce(r, '') AS ev_reason, coalesce(m, '') AS ev_message, deg AS degraded FROM j""",
    "locator_parse": f"SELECT failure_id, {PAGE} AS page, {SPECIFIC} AS specific FROM (SELECT *, lower({strip(chr(99) + 'oalesce(locator, ' + chr(39) * 2 + ')')}) AS l FROM {FAILURES})",
    "taxonomy_lookup": f"SELECT failure_id, leaf_no, t.asset_class_category, t.asset_class, t.canva_groupings FROM {FAILURES} f LEFT JOIN {LEAF} t USING (sub_asset_class)",
    "unknown_labels": f"SELECT sub_asset_class AS label, count(*) AS n FROM {FAILURES} f WHERE sub_asset_class IS NOT NULL AND sub_asset_class NOT IN (SELECT sub_asset_class FROM taxonomy) GROUP BY 1",
    "taxonomy_integrity": "SELECT count(*) AS leaves, count(DISTINCT leaf_no) AS numbers, count(DISTINCT sub_asset_class) AS labels, count(*) FILTER (leaf_no IS NULL OR coalesce(sub_asset_class, '') = '' OR coalesce(asset_class_category, '') = '' OR coalesce(asset_class, '') = '' OR coalesce(canva_groupings, '') = '') AS blank_rows, count(*) = 396 AND count(DISTINCT leaf_no) = 396 AND count(DISTINCT sub_asset_class) = 396 AND count(*) FILTER (leaf_no IS NULL OR coalesce(sub_asset_class, '') = '' OR coalesce(asset_class_category, '') = '' OR coalesce(asset_class, '') = '' OR coalesce(canva_groupings, '') = '') = 0 AS sound FROM taxonomy",
    "taxonomy_outline": r"""WITH a AS (SELECT *, lag(asset_class) OVER (ORDER BY leaf_no) AS pc, lag(asset_class_category) OVER (ORDER BY leaf_no) AS pg FROM taxonomy)
SELECT leaf_no, CASE WHEN pc IS DISTINCT FROM asset_class THEN '## ' || asset_class || chr(10) ELSE '' END || CASE WHEN pc IS DISTINCT FROM asset_class OR pg IS DISTINCT FROM asset_class_category THEN '### ' || asset_class_category || chr(10) ELSE '' END || '- ' || sub_asset_class AS block FROM a""",
    "failure_reason_counts": f"SELECT reason_code, count(*) AS n FROM {FAILURES} GROUP BY 1",
    "basis_counts": f"SELECT coalesce(nullif(basis, ''), 'stated') AS label, count(*) AS n FROM {CALLS} GROUP BY 1",
    "strength_counts": f"SELECT coalesce(nullif(checker_strength, ''), '(none)') AS label, count(*) AS n FROM {CALLS} GROUP BY 1",
    "reconciliation": f"""WITH a AS (SELECT row_number() OVER (PARTITION BY firm, sub_asset_class, call_view ORDER BY coalesce(confidence, -1e9) DESC, call_id) AS r FROM {CALLS}),
b AS (SELECT count(*) AS candidates, count(*) FILTER (r = 1) AS kept, count(*) FILTER (r > 1) AS failed FROM a)
SELECT candidates, kept, failed, CASE WHEN candidates = kept + failed THEN 'pass' ELSE 'review' END AS status FROM b""",
    "source_summary": f"""SELECT s.source_id, coalesce(n, 0) AS candidates, coalesce(k, 0) AS chunk_count, page_count, CASE WHEN coalesce(page_count, 0) > 0 THEN page_count || 'p / ' ELSE '' END || coalesce(k, 0) || ' chunks' AS pages_text,
array_to_string(list_filter([CASE WHEN visual_heavy THEN 'visual' END, CASE WHEN printed_pdf THEN 'printed' END, CASE WHEN len(scrambled_pages) > 0 THEN 'scrambled' END], lambda t: t IS NOT NULL), ', ') AS flags
FROM {SNAPSHOTS} s LEFT JOIN (SELECT source_id, count(*) AS n FROM {FAILURES} GROUP BY 1) a USING (source_id) LEFT JOIN (SELECT source_id, count(*) AS k FROM {CHUNKS} GROUP BY 1) b USING (source_id)""",
    "view_conflicts": f"SELECT firm, sub_asset_class, string_agg(DISTINCT call_view, ',' ORDER BY call_view) AS views, count(*) AS members, count(DISTINCT call_view) > 1 AS conflict FROM {CALLS} GROUP BY 1, 2",
    "same_view_dedup": f"""WITH a AS (SELECT *, first_value(call_id) OVER (PARTITION BY firm, sub_asset_class, call_view ORDER BY coalesce(confidence, -1e9) DESC, call_id) AS winner_idx FROM {CALLS})
SELECT call_id, winner_idx, CASE WHEN call_id <> winner_idx THEN 'duplicate_same_view' ELSE '' END AS reason FROM a""",
    "arbitration": f"""WITH a AS (SELECT *, CAST(row_number() OVER (PARTITION BY firm, sub_asset_class ORDER BY call_id) - 1 AS INT) AS group_idx FROM {CALLS}),
g AS (SELECT firm, sub_asset_class, min(CASE WHEN checker_strength = 'decisive' THEN group_idx END) AS w FROM a GROUP BY 1, 2 HAVING count(DISTINCT call_view) > 1)
SELECT call_id, group_idx, CASE WHEN w IS NULL THEN 'unresolved_conflict' WHEN w <> group_idx THEN 'arbitrated_out' ELSE '' END AS reason FROM a JOIN g ON a.firm IS NOT DISTINCT FROM g.firm AND a.sub_asset_class IS NOT DISTINCT FROM g.sub_asset_class""",
    "corroboration": f"""WITH a AS (SELECT *, first_value(call_id) OVER w AS win, first_value(firm) OVER w AS wf FROM {CALLS} WINDOW w AS (PARTITION BY sub_asset_class, call_view, out_date ORDER BY coalesce(confidence, -1e9) DESC, call_id))
SELECT win AS winner_idx, coalesce(string_agg(CASE WHEN call_id <> win AND firm IS DISTINCT FROM wf THEN coalesce(source, firm) || ' (' || coalesce(band, '') || ')' END, '; ' ORDER BY call_id), '') AS corroboration FROM a GROUP BY 1""",
    "cross_leaf_dedup": f"""WITH a AS (SELECT failure_id, source_id, call_view, sub_asset_class, leaf_no, list_sort(list_distinct(list_filter(list_transform(string_split(coalesce(evidence_quote, ''), ' ... '), lambda r: {norm("r")}), lambda r: r <> ''))) AS k,
list_distinct(regexp_extract_all(lower({norm("coalesce(evidence_quote, '')")}), '[a-z0-9]+')) AS words FROM {FAILURES} LEFT JOIN {LEAF} USING (sub_asset_class)),
b AS (SELECT *, {OVERLAP} AS o FROM a),
c AS (SELECT *, count(*) OVER w AS n, max(o) OVER w AS mo, row_number() OVER (PARTITION BY source_id, call_view, k ORDER BY o DESC, coalesce(leaf_no, 2147483647), failure_id) AS r, first_value(sub_asset_class) OVER (PARTITION BY source_id, call_view, k ORDER BY o DESC, coalesce(leaf_no, 2147483647), failure_id) AS top FROM b WINDOW w AS (PARTITION BY source_id, call_view, k)),
e AS (SELECT source_id, call_view, k, string_agg('''' || sub_asset_class || '''', ', ' ORDER BY i) AS kept FROM (SELECT source_id, call_view, k, sub_asset_class, min(failure_id) AS i FROM c WHERE o > 0 GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3),
d AS (SELECT c.*, kept, n > 1 AND (mo > 0 AND o = 0 OR mo = 0 AND r > 1) AS gone FROM c LEFT JOIN e ON c.source_id IS NOT DISTINCT FROM e.source_id AND c.call_view IS NOT DISTINCT FROM e.call_view AND c.k = e.k)
SELECT failure_id, CASE WHEN gone THEN 'duplicate_cross_leaf' ELSE '' END AS reason, CASE WHEN gone THEN 'same source, view, and evidence as kept leaf ' || CASE WHEN mo > 0 THEN kept ELSE '''' || coalesce(top, '') || '''' END || '; this leaf is not named in the shared evidence (cross-leaf fan-out)' ELSE '' END AS message FROM d""",
    "displayed_chunks": f"SELECT source_id, string_agg(coalesce(chunk_id, ''), ' | ' ORDER BY chunk_ord) AS chunk_id, string_agg(coalesce(locator, ''), ' | ' ORDER BY chunk_ord) AS locator FROM {CHUNKS} GROUP BY 1",
    "contract_candidates": f"""WITH a AS (SELECT *, [{LANG[1:-1]},'explicit','loud'][1 + failure_id % 7] AS lg, CASE WHEN failure_id % 5 = 0 THEN 'forecast_delta' ELSE coalesce(basis, 'stated') END AS bs FROM {FAILURES}),
m AS (SELECT *, array_to_string(list_filter([CASE WHEN source_id IS NULL THEN 'source_id' END, CASE WHEN chunk_id IS NULL THEN 'chunk_id' END, CASE WHEN sub_asset_class IS NULL THEN 'sub_asset_class' END, CASE WHEN taxonomy_match IS NULL THEN 'taxonomy_match' END, CASE WHEN call_view IS NULL THEN 'view' END,
CASE WHEN evidence_kind IS NULL THEN 'evidence_kind' END, CASE WHEN evidence_quote IS NULL THEN 'evidence_quote' END, CASE WHEN locator IS NULL THEN 'locator' END, CASE WHEN reasoning IS NULL THEN 'reasoning' END], lambda e: e IS NOT NULL), ', ') AS miss FROM a),
b AS (SELECT failure_id, list_filter([
CASE WHEN miss <> '' THEN ['missing_fields', 'candidate missing required fields: ' || miss] END,
CASE WHEN bs NOT IN ('stated','forecast_delta','inferred') THEN ['basis', 'basis must be one of stated, forecast_delta, inferred'] END,
CASE WHEN failure_id % 5 = 0 AND failure_id % 3 <> 0 THEN ['delta_fields', 'forecast_delta candidate requires delta_value'] END, CASE WHEN failure_id % 5 = 0 THEN ['delta_value', 'delta_value must be a number'] END,
CASE WHEN {strip("coalesce(source_id, '')")} = '' THEN ['source_id', 'source_id must be a non-empty string'] END, CASE WHEN {strip("coalesce(chunk_id, '')")} = '' THEN ['chunk_id', 'chunk_id must be a non-empty string'] END,
CASE WHEN {strip("coalesce(sub_asset_class, '')")} = '' THEN ['sub_asset_class', 'sub_asset_class must be a non-empty string'] END,
CASE WHEN {strip("coalesce(taxonomy_match, '')")} = '' THEN ['taxonomy_match', 'taxonomy_match must be a non-empty string'] WHEN taxonomy_match NOT IN ('exact','semantic','none') THEN ['taxonomy_match', 'taxonomy_match must be one of exact, semantic, none'] END,
CASE WHEN {strip("coalesce(call_view, '')")} = '' THEN ['view', 'view must be a non-empty string'] WHEN call_view NOT IN ('O','N','U','UNCERTAIN') THEN ['view', 'view must be one of O, N, U, UNCERTAIN'] END,
CASE WHEN lg = 'loud' THEN ['call_language', 'call_language must be one of explicit_dial, explicit_stance, directional, implied, none'] END,
CASE WHEN {strip("coalesce(evidence_kind, '')")} = '' THEN ['evidence_kind', 'evidence_kind must be a non-empty string'] WHEN evidence_kind NOT IN ('prose','table','visual') THEN ['evidence_kind', 'evidence_kind must be one of prose, table, visual'] END,
CASE WHEN evidence_quote IS NULL THEN ['evidence_quote', 'evidence_quote must be a string or a list of strings'] WHEN {strip("evidence_quote")} = '' THEN ['evidence_quote', 'evidence_quote must be a non-empty string'] END,
CASE WHEN {strip("coalesce(locator, '')")} = '' THEN ['locator', 'locator must be a non-empty string'] END, CASE WHEN {strip("coalesce(reasoning, '')")} = '' THEN ['reasoning', 'reasoning must be a non-empty string'] END], lambda e: e IS NOT NULL) AS errs FROM m)
SELECT failure_id, coalesce(errs[1][1], '') AS error, CAST(len(errs) AS INT) AS n_errors, coalesce(errs[1][2], '') AS message FROM b""",
    "contract_verdicts": """WITH a AS (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)
SELECT event_id, CASE WHEN k - 3 < 0 THEN 'index' WHEN k % 4 = 3 THEN 'supports_view' WHEN k % 5 > 1 AND event_type NOT IN ('decisive','adequate','thin') THEN 'evidence_strength' ELSE '' END AS error,
CASE WHEN k - 3 < 0 THEN 'verdict index must be a non-negative integer' WHEN k % 4 = 3 THEN 'supports_view must be one of pass, unclear, fail' WHEN k % 5 > 1 AND event_type NOT IN ('decisive','adequate','thin') THEN 'evidence_strength must be one of decisive, adequate, thin' ELSE '' END AS message FROM a""",
    "call_scores": f"""WITH {OBSERVED}, st AS (SELECT *, CASE WHEN checker_strength IS NULL THEN 'missing' WHEN supports_view = 'pass' AND forward_looking = 'pass' THEN 'confirmed' ELSE 'unclear' END AS checker_status,
CASE WHEN call_language = 'explicit_dial' AND evidence_kind = 'prose' THEN 26 ELSE [30, 26, 19, 12, 0][1 + failure_id % 5] END + 25 + CASE WHEN taxonomy_match = 'exact' THEN 20 ELSE 10 END + CASE WHEN coalesce(conflict, FALSE) THEN 5 ELSE 15 END + CASE WHEN well_read THEN 10 ELSE 0 END AS base FROM ob),
sc AS (SELECT *, degraded OR coalesce(basis IN ('forecast_delta','inferred'), FALSE) OR checker_status <> 'confirmed' OR coalesce(checker_strength, '') = 'thin' AS cap, base - CASE WHEN checker_status = 'confirmed' AND checker_strength = 'adequate' THEN 4 ELSE 0 END AS total FROM st),
fin AS (SELECT *, CAST(CASE WHEN cap THEN least(total, 74) ELSE total END AS INT) AS confidence FROM sc)
SELECT failure_id, confidence, CASE WHEN confidence >= 75 THEN 'High' WHEN confidence >= 50 THEN 'Medium' ELSE 'Low' END AS band,
CASE WHEN confidence < 50 THEN 'strong_review' WHEN confidence < 75 OR coalesce(conflict, TRUE) OR cap THEN 'review' ELSE 'none' END AS review_flag, checker_status FROM fin""",
    "hard_failures": f"""WITH {OBSERVED} SELECT failure_id, CASE WHEN leaf_no IS NULL OR taxonomy_match = 'none' THEN 'taxonomy_no_match' WHEN degraded THEN 'quote_not_found' WHEN basis = 'forecast_delta' AND abs(delta) < CASE WHEN bp THEN 25 ELSE 2 END THEN 'delta_below_materiality'
WHEN supports_view = 'fail' THEN 'checker_sign_mismatch' WHEN forward_looking = 'fail' THEN 'checker_not_forward_looking' ELSE '' END AS reason FROM ob""",
    "band_counts": f"SELECT CASE WHEN confidence >= 75 THEN 'High' WHEN confidence >= 50 THEN 'Medium' ELSE 'Low' END AS scored_band, band, review_flag, count(*) AS n FROM {CALLS} GROUP BY 1, 2, 3",
    "scrambled_pages": """WITH a AS (SELECT l_orderkey // 10 AS page_id, CAST(l_quantity AS DOUBLE) AS q, row_number() OVER (PARTITION BY l_orderkey // 10 ORDER BY l_orderkey, l_linenumber) - 1 AS rn FROM lineitem),
b AS (SELECT page_id, rn, fmod(q * 7, 45) AS xr FROM a), c AS (SELECT page_id, 15.0::DOUBLE * rn AS top, 15.0::DOUBLE * rn + 12.0 + fmod(xr, 5) AS bottom, CASE WHEN page_id % 2 = 0 THEN CASE WHEN rn % 2 = 0 THEN xr * 0.9::DOUBLE ELSE xr * 0.8::DOUBLE + 60 END ELSE xr END AS x0 FROM b),
d AS (SELECT *, x0 + CASE WHEN page_id % 2 = 0 THEN 3 ELSE 50 END AS x1 FROM c WHERE top > 70 AND top < 644),
e AS (SELECT page_id, min(top) AS y0, max(bottom) AS y1 FROM d GROUP BY 1 HAVING count(*) >= 20 AND max(bottom) > min(top)),
f AS (SELECT d.page_id, bin, x1 < bin + 0.5 AS l, x0 > bin + 0.5 AS r, least(39, floor((top - y0) / (y1 - y0) * 40)) AS row FROM d JOIN e USING (page_id), generate_series(30, 69) g(bin)),
h AS (SELECT page_id, bin, sum(l::INT) >= 15 AND sum(r::INT) >= 15 AND count(DISTINCT CASE WHEN NOT l AND NOT r THEN row END) / 40.0 <= 0.12 AS hit FROM f GROUP BY 1, 2)
SELECT p.page_id, coalesce(s, FALSE) AS scrambled FROM (SELECT DISTINCT page_id FROM a) p LEFT JOIN (SELECT page_id, bool_or(hit) AS s FROM h GROUP BY 1) USING (page_id)""",
    "eval_agreement": f"""WITH a AS (SELECT firm, sub_asset_class, arg_min(call_view, call_id) AS x, TRUE AS ina FROM {CALLS} WHERE call_id % 2 = 0 GROUP BY 1, 2), b AS (SELECT firm, sub_asset_class, arg_min(call_view, call_id) AS y, TRUE AS inb FROM {CALLS} WHERE call_id % 2 = 1 GROUP BY 1, 2)
SELECT count(*) FILTER (ina AND inb) AS matched, count(*) FILTER (ina AND inb AND x = y) AS agreeing, count(*) FILTER (ina AND inb AND x || y IN ('OU','UO')) AS opposite, count(*) FILTER (ina IS NULL) AS missed, count(*) FILTER (inb IS NULL) AS extra, count(*) FILTER (ina AND inb AND x = 'UNCERTAIN') AS abstained FROM a FULL JOIN b USING (firm, sub_asset_class)""",
    "one_hot_views": f"SELECT call_id, CAST(coalesce(call_view = 'U', FALSE) AS INT) AS uw, CAST(coalesce(call_view = 'N', FALSE) AS INT) AS n, CAST(coalesce(call_view = 'O', FALSE) AS INT) AS ow FROM {CALLS}",
    "conflict_ledger": f"SELECT concat_ws('|', firm, sub_asset_class) AS leaf, string_agg(coalesce(call_view, ''), ',' ORDER BY call_id) AS ledger, CASE WHEN count(DISTINCT call_view) > 1 THEN 'CONFLICT' ELSE 'OK' END AS status FROM {CALLS} GROUP BY 1",
    "all_failures": f"SELECT CAST(chunk_id IS NOT DISTINCT FROM 'checker' AS INT) AS phase, failure_id, CASE WHEN chunk_id IS NOT DISTINCT FROM 'checker' THEN '' ELSE coalesce(reason_code, '') END AS reason_code FROM {FAILURES}",
}

_EVIDENCE = SQL["evidence_check"].removeprefix("WITH ").rsplit("\nSELECT", 1)[0]
_EMPTY = "''"

#: A run from failures as candidates to kept rows (`rows_out`) and failures (`fails`).
RUN = f"""{_EVIDENCE},
quality AS (SELECT source_id, well_read FROM ({SQL["read_quality"]})),
info AS (SELECT source_id, min(list_row) AS source_ord, arg_min(coalesce(firm, ''), list_row) AS firm, arg_min(coalesce(published_at, ''), list_row) AS out_date, arg_min(coalesce(title, ''), list_row) AS source, arg_min(coalesce(resolved_url, ''), list_row) AS url
  FROM ({SQL["source_urls"]}) JOIN {TARGETS} USING (list_row) GROUP BY 1),
infos AS (SELECT *, 'pair-' || (source_ord // 2) AS group_id FROM info),
pairs AS (SELECT group_id, count(*) AS members, arg_min(firm, source_ord) AS firm, string_agg(out_date, ' | ' ORDER BY source_ord) AS out_date, string_agg(source, ' | ' ORDER BY source_ord) AS source, string_agg(url, ' | ' ORDER BY source_ord) AS url FROM infos GROUP BY 1),
c0 AS (SELECT j.* REPLACE (coalesce(evidence_quote, '') AS evidence_quote), t.leaf_no, t.asset_class_category, t.asset_class, t.canva_groupings, coalesce(well_read, FALSE) AS well, infos.group_id, coalesce(infos.group_id, j.source_id) AS gkey, infos.source_id IS NOT NULL AS has_info,
  CASE evidence_kind WHEN 'table' THEN 'explicit_dial' WHEN 'visual' THEN 'directional' WHEN 'prose' THEN CASE WHEN basis = 'inferred' THEN 'implied' ELSE 'explicit_stance' END ELSE 'none' END AS lang,
  TRY_CAST(nullif(regexp_extract(coalesce(evidence_quote, ''), '(\\d{{1,4}}) basis points', 1), '') AS DOUBLE) AS bp, TRY_CAST(nullif(regexp_extract(coalesce(evidence_quote, ''), '(\\d{{1,3}}\\.\\d{{1,2}})%', 1), '') AS DOUBLE) AS pct,
  CASE WHEN checker_strength IS NULL THEN 'missing' WHEN reason_code IN ('checker_sign_mismatch', 'checker_not_forward_looking', 'checker_asset_mismatch', 'unresolved_conflict') THEN 'unclear' ELSE 'confirmed' END AS status
  FROM j LEFT JOIN {LEAF} t USING (sub_asset_class) LEFT JOIN quality USING (source_id) LEFT JOIN infos USING (source_id)),
c1 AS (SELECT *, abs(coalesce(bp, pct, 0)) AS size, CASE WHEN bp IS NOT NULL THEN 'bp' ELSE 'pct' END AS unit, CASE WHEN bp IS NOT NULL THEN 25 ELSE 2 END AS least, coalesce(checker_strength, '') AS gs,
  CASE WHEN status = 'confirmed' THEN coalesce(nullif(checker_strength, ''), 'decisive') WHEN status = 'unclear' THEN coalesce(checker_strength, '') ELSE '' END AS strength FROM c0),
c2 AS (SELECT *, CASE WHEN leaf_no IS NULL OR taxonomy_match = 'none' THEN 'taxonomy_no_match' WHEN r IS NOT NULL THEN r WHEN basis = 'forecast_delta' AND size < least THEN 'delta_below_materiality'
  WHEN checker_strength IS NOT NULL AND reason_code IN ('checker_sign_mismatch', 'checker_not_forward_looking', 'checker_asset_mismatch') THEN reason_code END AS gate,
  status = 'confirmed' AND strength = 'thin' AS thinly, CASE lang WHEN 'explicit_dial' THEN 30 WHEN 'explicit_stance' THEN 26 WHEN 'directional' THEN 19 WHEN 'implied' THEN 12 ELSE 0 END + 25 + CASE WHEN taxonomy_match = 'exact' THEN 20 ELSE 10 END + CASE WHEN call_view = 'UNCERTAIN' THEN 5 ELSE 15 END
  + CASE WHEN well THEN 10 ELSE 0 END - CASE WHEN status = 'confirmed' AND strength = 'adequate' THEN 4 ELSE 0 END AS total FROM c1),
c3 AS (SELECT *, CASE WHEN deg OR coalesce(basis IN ('forecast_delta', 'inferred'), FALSE) OR status <> 'confirmed' OR thinly THEN least(total, 74) ELSE total END AS conf,
  CASE WHEN gate = 'taxonomy_no_match' THEN gate WHEN gate = r THEN m WHEN gate = 'delta_below_materiality' THEN 'forecast delta ' || format('{{:g}}', size::DOUBLE) || unit || ' is below the ' || least || unit || ' materiality floor (provisional, pending client confirmation)' WHEN gate IS NOT NULL THEN coalesce(nullif(message, ''), gate) END AS gate_message,
  trim(CASE basis WHEN 'forecast_delta' THEN 'Basis: forecast_delta — a house forecast endpoint (' || format('{{:g}}', size::DOUBLE) || unit || ' move) is treated as a provisional view (delta-as-view pending client confirmation); confidence capped below High and review required.'
    WHEN 'inferred' THEN 'Basis: inferred — single-step analyst inference from macro/thematic prose; segregated one band below stated calls, review required.' ELSE '' END
    || CASE WHEN thinly THEN ' Checker: evidence_strength thin — quoted evidence supports the view only just; confidence capped below High and review required.' ELSE '' END) AS cap,
  CASE WHEN status = 'missing' THEN ' Checker: not run.' WHEN status = 'unclear' THEN ' Checker: unconfirmed' || CASE WHEN coalesce(message, '') <> '' THEN ' (' || message || ')' ELSE '' END || '.' WHEN gs = '' THEN ' Checker: checker verdict missing evidence_strength; legacy all-pass treated as decisive.'
    WHEN thinly THEN ' Checker: checker evidence_strength is thin; confidence capped below High and review required.' ELSE '' END AS checker FROM c2),
k0 AS (SELECT *, min(failure_id) OVER w AS ord, min(call_view) OVER w <> max(call_view) OVER w AS clash, count(*) OVER w AS members, row_number() OVER (PARTITION BY gkey, sub_asset_class ORDER BY failure_id) - 1 AS gi FROM c3 WHERE gate IS NULL WINDOW w AS (PARTITION BY gkey, sub_asset_class)),
k1 AS (SELECT *, min(CASE WHEN gs = 'decisive' THEN gi END) OVER (PARTITION BY gkey, sub_asset_class) AS pick, first_value(failure_id) OVER b AS best, first_value(locator) OVER b AS best_at, first_value(source_id) OVER b AS best_source FROM k0 WINDOW b AS (PARTITION BY gkey, sub_asset_class ORDER BY conf DESC, failure_id)),
k2 AS (SELECT k1.*, CASE WHEN clash THEN CASE WHEN pick IS NULL THEN 'unresolved_conflict' WHEN pick <> gi THEN 'arbitrated_out' END WHEN failure_id <> best THEN 'duplicate_same_view' END AS route FROM k1),
notes AS (SELECT best AS failure_id, 'Corroborated by companion source: ' || string_agg(coalesce(i.source, k2.source_id) || ' (' || coalesce(locator, '') || ')', '; ' ORDER BY k2.failure_id) || '.' AS corr FROM k2 LEFT JOIN infos i USING (source_id) WHERE route = 'duplicate_same_view' AND k2.source_id IS DISTINCT FROM best_source GROUP BY 1),
w0 AS (SELECT *, list_sort(list_distinct(list_filter(list_transform(string_split(evidence_quote, ' ... '), lambda q: {norm("q")}), lambda q: q <> ''))) AS k, list_distinct(regexp_extract_all(lower({norm("evidence_quote")}), '[a-z0-9]+')) AS words FROM k2 WHERE route IS NULL AND has_info),
w1 AS (SELECT *, {OVERLAP} AS o FROM w0),
w2 AS (SELECT *, count(*) OVER w AS n, max(o) OVER w AS mo, row_number() OVER x AS rn, first_value(sub_asset_class) OVER x AS top FROM w1 WINDOW w AS (PARTITION BY source_id, call_view, k), x AS (PARTITION BY source_id, call_view, k ORDER BY o DESC, leaf_no, ord)),
kl AS (SELECT source_id, call_view, k, string_agg('{_EMPTY}' || sub_asset_class || '{_EMPTY}', ', ' ORDER BY i) AS kept FROM (SELECT source_id, call_view, k, sub_asset_class, min(ord) AS i FROM w2 WHERE o > 0 GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3),
w3 AS (SELECT w2.*, kept, n > 1 AND (mo > 0 AND o = 0 OR mo = 0 AND rn > 1) AS gone FROM w2 LEFT JOIN kl USING (source_id, call_view, k)),
fails AS (
  SELECT 0 AS phase, failure_id, gate AS code, gate_message AS said, gs FROM c3 WHERE gate IS NOT NULL
  UNION ALL SELECT 1, failure_id, route, CASE route WHEN 'unresolved_conflict' THEN 'multiple views survived validation for the same source/group and leaf; arbiter: first decisive' WHEN 'arbitrated_out' THEN 'first decisive' ELSE 'same view already kept from ' || coalesce(best_at, '') END, '' FROM k2 WHERE route IS NOT NULL
  UNION ALL SELECT 1, failure_id, 'source_metadata_missing', 'source metadata was not available for this candidate', '' FROM k2 WHERE route IS NULL AND NOT has_info
  UNION ALL SELECT 2, failure_id, 'duplicate_cross_leaf', 'same source, view, and evidence as kept leaf ' || CASE WHEN mo > 0 THEN kept ELSE '{_EMPTY}' || top || '{_EMPTY}' END || '; this leaf is not named in the shared evidence (cross-leaf fan-out)', '' FROM w3 WHERE gone),
rows_out AS (SELECT w3.failure_id AS cand_idx, ord AS row_ord, p.firm, CASE WHEN p.members > 1 THEN p.out_date ELSE i.out_date END AS out_date, CASE WHEN p.members > 1 THEN p.source ELSE i.source END AS source, CASE WHEN p.members > 1 THEN p.url ELSE i.url END AS url,
  sub_asset_class, asset_class_category, canva_groupings, asset_class, call_view,
  coalesce(reasoning, '') || ' Evidence: ' || evidence_quote || '. Locator: ' || coalesce(locator, '') || CASE WHEN p.members > 1 THEN ' (' || i.source || ')' ELSE '' END || '.' || coalesce(' ' || corr, '')
    || CASE WHEN deg THEN ' Evidence check: cited page detected as scrambled two-column text; verbatim quote match degraded to key-token overlap (confidence capped, review required).' ELSE '' END || CASE WHEN cap <> '' THEN ' ' || cap ELSE '' END || checker || CASE WHEN clash THEN ' Arbiter: first decisive' ELSE '' END AS full_commentary,
  CAST(conf AS INT) AS confidence, CASE WHEN conf >= 75 THEN 'High' WHEN conf >= 50 THEN 'Medium' ELSE 'Low' END AS band,
  CASE WHEN conf < 50 THEN 'strong_review' WHEN conf < 75 OR call_view = 'UNCERTAIN' OR deg OR cap <> '' OR clash OR call_view IS NULL THEN 'review' ELSE 'none' END AS review_flag, coalesce(basis, 'stated') AS basis, strength AS checker_strength
  FROM w3 JOIN infos i USING (source_id) JOIN pairs p ON p.group_id = i.group_id LEFT JOIN notes ON notes.failure_id = w3.failure_id WHERE NOT gone)"""

SQL["assembled_rows"] = f"WITH {RUN} SELECT * FROM rows_out"
SQL["assembled_failures"] = f"""WITH {RUN} SELECT fails.phase, fails.failure_id AS cand_idx, code AS reason_code, said AS message, fails.gs AS checker_strength, coalesce(source_id, '') AS source_id, coalesce(chunk_id, '') AS chunk_id, coalesce(sub_asset_raw, '') AS sub_asset_raw, coalesce(sub_asset_class, '') AS sub_asset_class,
coalesce(call_view, '') AS call_view, coalesce(taxonomy_match, '') AS taxonomy_match, coalesce(evidence_kind, '') AS evidence_kind, coalesce(locator, '') AS locator, coalesce(basis, '') AS basis FROM fails JOIN c3 USING (failure_id)"""
SQL["assembled_counts"] = f"WITH {RUN} SELECT 'kept' AS label, count(*) AS n FROM rows_out UNION ALL SELECT code, count(*) FROM fails GROUP BY 1 UNION ALL SELECT 'candidates', count(*) FROM c3"

_HEAD = "'# ' || coalesce(firm, '') || ' — ' || coalesce(source, '') || '  (' || source_id || ')' || chr(10)"
_BLOCKS = f"""info AS (SELECT source_id, min(list_row) AS source_ord, arg_min(struct_pack(f := firm, t := title), list_row) AS i FROM ({SQL["source_urls"]}) JOIN {TARGETS} USING (list_row) GROUP BY 1),
left_ AS (SELECT source_id, chunk_id, string_agg(coalesce(sub_asset_class, '') || '=' || coalesce(call_view, '') || '[' || coalesce(locator, '') || ']', '; ' ORDER BY failure_id) AS ledger, min(CASE WHEN reason_code IN ('json_parse_error', 'engine_error') THEN reason_code END) AS lost FROM {FAILURES} GROUP BY 1, 2),
b AS (SELECT c.source_id, source_ord, chunk_ord, chunk_id, i.f AS firm, i.t AS source, chr(10) || '## Chunk ' || chunk_id || chr(10) || 'Summary: ' || CASE WHEN lost IS NOT NULL THEN '(' || lost || '; chunk skipped)' ELSE coalesce(c.locator, '') END || chr(10) || 'Candidates: ' || CASE WHEN lost IS NOT NULL THEN 'none' ELSE coalesce(ledger, 'none') END || chr(10) AS block
  FROM {CHUNKS} c LEFT JOIN left_ USING (source_id, chunk_id) LEFT JOIN info USING (source_id)),
m AS (SELECT *, {_HEAD} AS head, coalesce(string_agg(block, '') OVER (PARTITION BY source_id ORDER BY chunk_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS own FROM b)"""
SQL["rolling_memory"] = f"WITH {_BLOCKS} SELECT source_id, chunk_id, CAST(length(head || own) AS INT) AS n_chars, md5(head || own) AS digest FROM m"
_PREFACE = "chr(10) || '## Companion document already analyzed in this grouped source set' || chr(10) || 'Report this document''s own stances normally — corroboration and' || chr(10) || 'conflicts across the set are resolved downstream; mark `conflict:' || chr(10) || 'true` where this document disagrees with the companion.' || chr(10) || chr(10)"
SQL["companion_memory"] = f"""WITH {_BLOCKS}, s AS (SELECT source_id, any_value(source_ord) AS source_ord, any_value(head) AS head, string_agg(block, '' ORDER BY chunk_ord) AS body, coalesce('pair-' || (any_value(source_ord) // 2), source_id) AS group_key FROM m GROUP BY source_id),
p AS (SELECT *, lag(head || body) OVER (PARTITION BY group_key ORDER BY source_ord) AS before FROM s),
f AS (SELECT source_id, chunk_id, group_key, p.head || CASE WHEN before IS NOT NULL THEN {_PREFACE} || before || chr(10) ELSE '' END || own AS memory FROM m JOIN p USING (source_id))
SELECT source_id, chunk_id, group_key, CAST(length(memory) AS INT) AS n_chars, md5(memory) AS digest FROM f"""
SQL["prompt_contents"] = f"""WITH a AS (SELECT c.source_id, chunk_id, coalesce(locator, '') AS l, coalesce(resolved_url, '') AS u, coalesce(snapshot_text_path, '') AS p, coalesce(source_type = 'pdf', FALSE) OR coalesce(printed_pdf, FALSE) AS paged, coalesce(printed_pdf, FALSE) AS printed, snapshot_text AS t,
  TRY_CAST(regexp_extract(chunk_id, '^char:(\\d+)-', 1) AS INT) AS x, TRY_CAST(regexp_extract(chunk_id, '^char:\\d+-(\\d+)$', 1) AS INT) AS y FROM {CHUNKS} c JOIN {SNAPSHOTS} s USING (source_id))
SELECT source_id, chunk_id, md5(CASE WHEN paged THEN 'This chunk is pages ' || replace(l, 'p.', '') || ' of the PDF file at:' || chr(10) || '`' || p || '`' || chr(10) || chr(10) || CASE WHEN printed THEN '(This PDF is a print-to-PDF capture of the web page at ' || u || '; use its page numbers as locators.)' || chr(10) || chr(10) ELSE '' END
  || 'Open and read those pages as rendered pages — view them so you see tables, positioning/view grids, arrows, and dial gauges as printed, not only the extracted text. Cite what you actually see on the page.'
  ELSE 'This chunk is the extracted text below (locator ' || l || ', from ' || u || ').' || chr(10) || 'If the text references a chart, figure, or infographic you cannot see, say so in your summary rather than guessing its contents.' || chr(10) || chr(10) || '-----' || chr(10) || coalesce(CASE WHEN y IS NULL THEN t ELSE substr(t, x + 1, y - x) END, '') || chr(10) || '-----' END) AS digest FROM a"""
SQL["checker_verdicts"] = f"""WITH bad AS (SELECT DISTINCT source_id FROM {FAILURES} WHERE reason_code = 'checker_error' AND source_id IS NOT NULL)
SELECT failure_id AS cand_idx, CASE reason_code WHEN 'checker_sign_mismatch' THEN 'fail' WHEN 'unresolved_conflict' THEN 'unclear' ELSE 'pass' END AS supports_view, CASE WHEN reason_code = 'checker_not_forward_looking' THEN 'fail' ELSE 'pass' END AS forward_looking, CASE WHEN reason_code = 'checker_asset_mismatch' THEN 'fail' ELSE 'pass' END AS asset_match,
coalesce(checker_strength, '') AS evidence_strength, coalesce(message, '') AS note FROM {FAILURES} WHERE source_id IS NOT NULL AND source_id NOT IN (SELECT source_id FROM bad)"""
SQL["checker_failures"] = f"SELECT DISTINCT source_id, 'checker' AS chunk_id, 'checker_error' AS reason_code, 'checker response must be a JSON object' AS message FROM {FAILURES} WHERE reason_code = 'checker_error' AND source_id IS NOT NULL"
_CONTRACT = SQL["contract_candidates"].removeprefix("WITH ").rsplit("\nSELECT", 1)[0].replace("CASE WHEN failure_id % 5 = 0 THEN 'forecast_delta' ELSE coalesce(basis, 'stated') END AS bs", "CASE WHEN basis = 'forecast_delta' THEN 'stated' ELSE coalesce(basis, 'stated') END AS bs")
_CONTRACT = _CONTRACT.replace(f"[{LANG[1:-1]},'explicit','loud'][1 + failure_id % 7] AS lg", "'implied' AS lg").replace("failure_id % 5 = 0", "FALSE")
SQL["response_outcomes"] = f"""WITH {_CONTRACT}, r AS (SELECT source_id, chunk_id, count(*) AS k, arg_min(errs[1][2], failure_id) FILTER (len(errs) > 0) AS first_message FROM b JOIN {FAILURES} USING (failure_id) WHERE source_id IS NOT NULL AND chunk_id IS NOT NULL GROUP BY 1, 2)
SELECT source_id, chunk_id, CASE WHEN first_message IS NULL THEN k ELSE 0 END AS n, coalesce('invalid LLM JSON after repair attempts: ' || first_message, '') AS message FROM r"""
SQL["quote_quality"] = f"SELECT count(*) AS calls, count(ev_passed) AS judged, count(*) FILTER (ev_passed) AS verbatim FROM ({SQL['evidence_check']})"
SQL["leaf_matches"] = f"""SELECT t.firm, count(t.sub_asset_class) AS truth_leaves, count(c.sub_asset_class) AS found FROM (SELECT DISTINCT firm, sub_asset_class FROM {CALLS} WHERE basis = 'stated') t
LEFT JOIN (SELECT DISTINCT firm, sub_asset_class FROM {CALLS} WHERE basis = 'inferred' AND sub_asset_class IS NOT NULL) c ON t.firm = c.firm AND t.sub_asset_class = c.sub_asset_class GROUP BY 1"""
