"""DuckDB SQL of those queries that SQL can express on whole tables."""

_NO_AUTHOR = "('et al', 'et al.', 'anonymous', 'anon', 'anon.', 'various authors', 'various', 'unknown', 'unknown author', 'n/a', 'na', 'none', 'null', '-', 'tbd', 'staff', 'author', 'authors')"
_AUTHOR = r"""regexp_replace(lower(trim(regexp_replace(a, '[\s\x{00A0}\x{2007}\x{202F}]+', ' ', 'g'), ' ')), '\s*(?:\(\w{1,2}\)|\[\w{1,2}\]|[*†‡§¶#¹²³⁰-⁹]+|[\s,]\d{1,2}(?:,\d{1,2})*)+\s*$', '')"""
_DOI = r"""trim(regexp_replace(lower(trim(doi, ' ')), '^(?:https?://(?:dx\.)?doi\.org/|doi:?\s*)+', ''), ' ')"""

SQL: dict[str, str] = {
    "p4_found": rf"""WITH RECURSIVE a AS (SELECT id, {_AUTHOR} AS x FROM (SELECT id, unnest(authors) AS a FROM core_documents WHERE id IS NOT NULL)),
        s AS (SELECT id, s, CASE WHEN starts_with(x, s) THEN regexp_replace(substr(x, length(s) + 1), '^[:\-_/]+', '') ELSE x END AS x FROM
          (SELECT id, lower(regexp_replace(source, '\s+', '', 'g')) AS s, lower(regexp_replace(source_id, '[\s\x{{00A0}}]+', '', 'g')) AS x FROM core_documents WHERE id IS NOT NULL)),
        t AS (SELECT DISTINCT id, 'a' || array_to_string(list_sort(list_filter(string_split(replace(x, ',', ' '), ' '), lambda p: length(p) > 0)), ' ') AS tie FROM a WHERE x NOT IN {_NO_AUTHOR} AND length(x) >= 2 AND contains(replace(x, ',', ' '), ' ')
          UNION SELECT id, 'd' || d FROM (SELECT id, {_DOI} AS d FROM core_documents WHERE id IS NOT NULL) WHERE regexp_matches(d, '^10\.\d{{4,9}}/\S+')
          UNION SELECT id, 's' || s || chr(1) || regexp_replace(x, 'v\d+$', '') FROM s WHERE length(regexp_replace(x, 'v\d+$', '')) > 0 AND length(s) > 0),
        r AS (SELECT DISTINCT id, id AS root FROM t UNION SELECT y.id, r.root FROM r JOIN t x ON x.id = r.id JOIN t y ON y.tie = x.tie),
        g AS (SELECT id, min(root) AS group_id FROM r GROUP BY 1) SELECT id, group_id FROM g WHERE group_id IN (SELECT group_id FROM g GROUP BY 1 HAVING count(*) > 1)""",
}
