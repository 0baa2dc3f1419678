"""DuckDB SQL of the typeset tables, as common table expressions that the oracle queries build on."""

from __future__ import annotations

from ..sources import typeset as t

_in = lambda words: "(" + ", ".join(f"'{w}'" for w in words) + ")"

#: In order; each may use those before it.
CTES = {
    "tl": rf"SELECT doc_id, list_filter(string_split_regex(text, '{t.SPACE}'), lambda x: x <> '') AS l FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL",
    "tok": "SELECT doc_id, unnest(l) AS raw, generate_subscripts(l, 1) - 1 AS w FROM tl",
    "raw_words": """
        SELECT page_num * 1000 + w % 400 AS id, page_num, line_idx, w::INT AS w, raw, n, x0::INT AS bbox_x0, (140 + 44 * line_idx + n % 3)::INT AS bbox_y0,
               (x0 + 12 * n)::INT AS bbox_x1, (140 + 44 * line_idx + n % 3 + 28)::INT AS bbox_y1, 0.5::DOUBLE + ((w * 37) % 50) / 100.0::DOUBLE AS conf
        FROM (SELECT doc_id * 100000 + (w // 10) // 40 AS page_num, ((w // 10) % 40)::INT AS line_idx, w, raw, length(raw)::INT AS n,
                     150 + 12 * coalesce(sum(length(raw) + 1) OVER (PARTITION BY doc_id, w // 10 ORDER BY w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 3 * (w % 5) AS x0 FROM tok)""",
    "words": rf"""
        SELECT id, page_num, regexp_extract(raw, '{t.CORE}', 2) AS text, bbox_x0, bbox_y0, bbox_x1, bbox_y1, line_idx, conf,
               nullif(regexp_extract(raw, '{t.CORE}', 1), '') AS prefix, nullif(regexp_extract(raw, '{t.CORE}', 3), '') AS suffix, w
        FROM raw_words WHERE regexp_extract(raw, '{t.CORE}', 2) <> ''""",
    "freq": "SELECT lower(text) AS lemma, count(*)::DOUBLE / sum(count(*)) OVER ()::DOUBLE AS frequency FROM words GROUP BY 1",
    "tagged": f"""
        SELECT *, CASE WHEN lower(text) IN {_in(t.DET)} THEN 'DET' WHEN lower(text) IN {_in(t.ADP)} THEN 'ADP' WHEN lower(text) IN {_in(t.PRON)} THEN 'PRON'
                 WHEN lower(text) IN {_in(t.AUX)} THEN 'AUX' WHEN lower(text) IN {_in(t.CCONJ)} THEN 'CCONJ' WHEN lower(text) IN {_in(t.SCONJ)} THEN 'SCONJ'
                 WHEN lower(text) IN {_in(t.PART)} THEN 'PART' WHEN regexp_matches(text, '^[0-9]+$') THEN 'NUM' WHEN w % 10 <> 0 AND regexp_matches(text, '^[A-Z]') THEN 'PROPN'
                 WHEN regexp_matches(lower(text), 'ly$') THEN 'ADV' WHEN regexp_matches(lower(text), '(ing|ed)$') THEN 'VERB' WHEN regexp_matches(lower(text), '(ous|ful|ble)$') THEN 'ADJ' ELSE 'NOUN' END AS pos
        FROM words""",
    "feat": f"""
        SELECT tagged.*, freq.lemma, frequency, round(CASE WHEN frequency <= 0 THEN 6.0 ELSE least(6.0, -log10(frequency)) END, 4) AS rarity,
               (pos IN {_in(t.CONTENT)})::INT AS is_content, (pos IN {_in(t.CONNECTIVE)} OR freq.lemma IN {_in(t.CONNECTIVE_WORDS)})::INT AS is_connective
        FROM tagged JOIN freq ON freq.lemma = lower(text)""",
    "pg": "SELECT page_num, 'p' || CASE WHEN length(page_num::VARCHAR) < 4 THEN lpad(page_num::VARCHAR, 4, '0') ELSE page_num::VARCHAR END || '.jpg' AS image_path, 1400 AS width_px, CASE WHEN page_num % 89 = 0 THEN 2099 ELSE 2100 END AS height_px FROM (SELECT DISTINCT page_num FROM words WHERE page_num % 97 <> 0)",
    "corr": """
        SELECT page_num, (page_num * 13 % 21 - 10) / 10.0::DOUBLE AS angle, (page_num % 9 - 4)::DOUBLE AS dx, (page_num % 7 - 3)::DOUBLE AS dy,
               CASE WHEN page_num % 5 = 0 THEN 500 END AS title_x0, CASE WHEN page_num % 5 = 0 THEN 60 END AS title_y0, CASE WHEN page_num % 5 = 0 THEN 900 END AS title_x1, CASE WHEN page_num % 5 = 0 THEN 95 END AS title_y1,
               4 AS valid_x0, 6 AS valid_y0, 1396 AS valid_x1, 2094 AS valid_y1,
               CASE WHEN page_num % 7 <> 0 THEN 120 END AS body_x0, CASE WHEN page_num % 7 <> 0 THEN 110 END AS body_y0, CASE WHEN page_num % 7 <> 0 THEN max(bbox_x1) + 40 END AS body_x1, CASE WHEN page_num % 7 <> 0 THEN max(bbox_y1) + 30 END AS body_y1
        FROM words WHERE page_num % 11 <> 0 GROUP BY page_num""",
    "bodies": """
        SELECT e.page_num, coalesce(body_x0, ex0) AS x0, coalesce(body_y0, ey0) AS y0, coalesce(body_x1, ex1) AS x1, coalesce(body_y1, ey1) AS y1
        FROM (SELECT page_num, min(bbox_x0) AS ex0, min(bbox_y0) AS ey0, max(bbox_x1) AS ex1, max(bbox_y1) AS ey1 FROM words GROUP BY page_num) e LEFT JOIN corr USING (page_num)""",
    "ln": "SELECT page_num, line_idx, min(bbox_x0) AS x0, min(bbox_y0) AS y0, max(bbox_x1) AS x1, max(bbox_y1) AS y1, count(*) AS n FROM words GROUP BY page_num, line_idx",
    "hg": """
        SELECT page_num, (row_number() OVER (PARTITION BY page_num ORDER BY ord, line_idx_a) - 1)::INT AS gutter_id, 'h_line' AS kind, line_idx_a, line_idx_b, gx0 AS x0, gy0 AS y0, gx1 AS x1, gy1 AS y1
        FROM (SELECT page_num, 0 AS ord, NULL::INT AS line_idx_a, min_by(ln.line_idx, ln.line_idx) AS line_idx_b, any_value(b.x0) AS gx0, any_value(b.y0) AS gy0, any_value(b.x1) AS gx1, min_by(ln.y0, ln.line_idx) AS gy1 FROM ln JOIN bodies b USING (page_num) GROUP BY page_num
              UNION ALL SELECT page_num, 1, line_idx, lead(line_idx) OVER p, b.x0, ln.y1, b.x1, lead(ln.y0) OVER p FROM ln JOIN bodies b USING (page_num) WINDOW p AS (PARTITION BY page_num ORDER BY line_idx)
              UNION ALL SELECT page_num, 2, max(ln.line_idx), NULL, any_value(b.x0), max_by(ln.y1, ln.line_idx), any_value(b.x1), any_value(b.y1) FROM ln JOIN bodies b USING (page_num) GROUP BY page_num)
        WHERE gy1 > gy0 + 1""",
    "vs": """
        SELECT page_num, (coalesce(k, 0) + row_number() OVER (PARTITION BY page_num ORDER BY line_idx, ord, sx0, id) - 1)::INT AS gutter_id, 'v_slit' AS kind, line_idx AS line_idx_a, sx0 AS x0, ly0 AS y0, sx1 AS x1, ly1 AS y1
        FROM (SELECT ln.page_num, ln.line_idx, 0 AS ord, 0 AS id, b.x0 AS sx0, ln.x0 AS sx1, ln.y0 AS ly0, ln.y1 AS ly1 FROM ln JOIN bodies b USING (page_num)
              UNION ALL SELECT words.page_num, words.line_idx, 1, words.id, bbox_x1, coalesce(lead(bbox_x0) OVER (PARTITION BY words.page_num, words.line_idx ORDER BY bbox_x0, id), b.x1), ln.y0, ln.y1
              FROM words JOIN ln USING (page_num, line_idx) JOIN bodies b ON b.page_num = words.page_num)
        LEFT JOIN (SELECT page_num, count(*) AS k FROM hg GROUP BY page_num) USING (page_num) WHERE sx1 > sx0 + 1""",
}


def needs(text: str) -> list[str]:
    """The tables that a query uses, and what these use, in order."""
    import re

    used: set[str] = set()
    todo = [text]
    while todo:
        now = todo.pop()
        for name in CTES:
            if name not in used and re.search(rf"\b{name}\b", now):
                used.add(name)
                todo.append(CTES[name])
    return [n for n in CTES if n in used]


def sql(text: str) -> str:
    """text with the tables that it uses in front; text may begin with WITH or WITH RECURSIVE."""
    head = text.strip()
    recursive = head.startswith("WITH RECURSIVE")
    rest = head.removeprefix("WITH RECURSIVE").strip() if recursive else head.removeprefix("WITH ").strip() if head.startswith("WITH ") else None
    own = ", ".join(f"{n} AS MATERIALIZED ({CTES[n]})" if n in ("words", "feat", "ln", "hg", "vs", "bodies") else f"{n} AS ({CTES[n]})" for n in needs(text))
    if not own:
        return head
    return f"WITH {'RECURSIVE ' if recursive else ''}{own}{', ' + rest if rest else ' ' + head}"
