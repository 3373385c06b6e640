"""The same results in DuckDB SQL, by plain means, where SQL can express them."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    folded = f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"
    return rf"regexp_extract_all({folded}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


DECONTAMINATION = f"""
WITH b AS (SELECT item_id, {_words("text")} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size,
         list_aggregate(list_slice(w, i, i + least(13, len(w)) - 1), 'string_agg', ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {_words("text")} AS w FROM documents),
dw AS (
  SELECT doc_id, i, s.size, list_aggregate(list_slice(w, i, i + s.size - 1), 'string_agg', ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)
  JOIN (SELECT DISTINCT size FROM bw) s ON i + s.size - 1 <= len(w)),
hits AS (SELECT doc_id, i, size, item_id FROM dw JOIN bw USING (size, win)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

SUBSTRINGS = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
win AS (
  SELECT r, i, md5(list_aggregate(list_slice(w, i, i + 34), 'string_agg', ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
again AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM win JOIN again USING (h)),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d)
  ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

URL_RULES = rf"""
WITH r(host, path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rest AS (
  SELECT row_number() OVER () AS n, page_id,
         CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
u AS (
  SELECT n, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
fit AS (
  SELECT n, arg_max(r.host || r.path, length(r.host) + length(r.path)) AS rule,
         arg_max(verdict, length(r.host) + length(r.path)) AS verdict
  FROM u JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN fit USING (n)
"""
