"""The licence scan as SQL: every passage is weighed, and nothing is left out by anchors."""

from tidemark.llm.license_scan import HEADER, LINE, NAME, TEMPLATES, TERM, WHOLE


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_ROWS = ", ".join(f"({i}, {_text(name)}, {_text(text)})" for i, (name, text) in enumerate(TEMPLATES))


def scan_sql(files: str) -> str:
    """``files``: a query for doc_id, path and text, one row per path."""
    return f"""
WITH f AS ({files}), n AS (SELECT count(*) AS n FROM f),
  tf AS (SELECT template, license, term, count(*) AS tf FROM (SELECT template, license,
      unnest(regexp_extract_all(lower(text), '{TERM}')) AS term FROM (VALUES {_ROWS}) t(template, license, text)) GROUP BY ALL),
  df AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '{TERM}'))) AS term FROM f)
    WHERE term IN (SELECT term FROM tf) GROUP BY term),
  w AS (SELECT template, license, tf.term, ln((1.0 + n) / (1.0 + coalesce(df, 0))) + 1.0 AS idf,
      tf * (ln((1.0 + n) / (1.0 + coalesce(df, 0))) + 1.0) AS w FROM tf LEFT JOIN df ON tf.term = df.term, n),
  norms AS (SELECT template, sqrt(sum(w * w)) AS norm FROM w GROUP BY template),
  lines AS (SELECT *, string_split(text, chr(10)) AS l, regexp_extract(text, '{HEADER}') AS header FROM f WHERE text IS NOT NULL),
  passages AS (SELECT path, 'line' AS kind, i AS no, l[i + 1] AS p FROM lines, unnest(range(len(l))) u(i)
    UNION ALL SELECT path, CASE header WHEN '' THEN 'file' ELSE 'line' END, -1,
      CASE header WHEN '' THEN text ELSE header END FROM lines),
  counted AS (SELECT path, kind, no, term, count(*) AS tf FROM (SELECT path, kind, no,
      unnest(regexp_extract_all(lower(p), '{TERM}')) AS term FROM passages) GROUP BY ALL),
  valued AS (SELECT c.*, c.tf * coalesce(i.idf, ln(1.0 + n) + 1.0) AS v FROM counted c
    LEFT JOIN (SELECT DISTINCT term, idf FROM w) i ON c.term = i.term, n),
  lengths AS (SELECT path, kind, no, sqrt(sum(v * v)) AS norm FROM valued GROUP BY ALL),
  dots AS (SELECT path, kind, no, w.template, license, round(sum(v * w / norms.norm), 9) AS dot FROM valued
    JOIN w ON valued.term = w.term JOIN norms ON w.template = norms.template GROUP BY ALL),
  best AS (SELECT d.path, d.kind, license, template, round(dot / norm, 6) AS score FROM dots d
    JOIN lengths l ON d.path = l.path AND d.kind = l.kind AND d.no = l.no
    QUALIFY row_number() OVER (PARTITION BY d.path, d.kind, d.no ORDER BY dot DESC, template) = 1),
  chosen AS (SELECT * FROM best WHERE score >= CASE kind WHEN 'line' THEN {LINE} ELSE {WHOLE} END
    QUALIFY row_number() OVER (PARTITION BY path, kind ORDER BY score DESC, template) = 1),
  own AS (SELECT * FROM chosen WHERE kind = 'line'), whole AS (SELECT * FROM chosen WHERE kind = 'file'),
  j AS (SELECT f.doc_id, f.path, own.license AS own_license, own.score AS own_score,
      whole.path IS NOT NULL OR (own.path IS NOT NULL AND regexp_matches(regexp_extract(f.path, '[^/]*$'), '{NAME}'))
        AS is_license_file, coalesce(whole.license, own.license) AS said, coalesce(whole.score, own.score) AS score,
      CASE WHEN contains(f.path, '/') THEN regexp_replace(f.path, '/[^/]*$', '') ELSE '' END AS folder
    FROM f LEFT JOIN own ON f.path = own.path LEFT JOIN whole ON f.path = whole.path),
  folders AS (SELECT folder, said FROM j WHERE is_license_file
    QUALIFY row_number() OVER (PARTITION BY folder ORDER BY score DESC, path) = 1),
  parts AS (SELECT folder, list_filter(string_split(folder, '/'), lambda x: x <> '') AS p FROM (SELECT DISTINCT folder FROM j)),
  above AS (SELECT folder, i AS up, array_to_string(p[:len(p) - i], '/') AS ancestor FROM parts, unnest(range(len(p) + 1)) u(i)),
  inherited AS (SELECT above.folder, ancestor, said FROM above JOIN folders ON folders.folder = ancestor
    QUALIFY row_number() OVER (PARTITION BY above.folder ORDER BY up) = 1)
SELECT doc_id, path, own_license, own_score, is_license_file,
  CASE WHEN own_license IS NULL THEN ancestor END AS inherited_from,
  coalesce(own_license, i.said) AS license FROM j LEFT JOIN inherited i ON j.folder = i.folder"""
