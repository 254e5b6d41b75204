"""SQL that states what queries of this subpackage return, where SQL can."""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def contamination(window: int = 13, share: int = 20) -> str:
    """Every run of words that equals a window of an item, by its words."""
    words = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    piece = "array_to_string(list_slice(w, p + 1, p + size), ' ')"
    return f"""
    WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {words} AS w, least({window}, len(w)) AS size FROM benchmark WHERE text IS NOT NULL),
    windows AS (SELECT DISTINCT item_id, size, {piece} AS span FROM (SELECT item_id, w, size, unnest(range(len(w) - size + 1)) AS p FROM items WHERE size > 0)),
    docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce({words}, []) AS w FROM documents),
    spans AS (SELECT r, p, size, {piece} AS span FROM (
        SELECT r, w, size, unnest(range(len(w) - size + 1)) AS p FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
    hits AS (SELECT r, p, size, item_id FROM spans JOIN windows USING (size, span)),
    words AS (SELECT r, count(DISTINCT spot) AS n_hit FROM (SELECT r, unnest(range(p, p + size)) AS spot FROM hits) GROUP BY r),
    names AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AND {share} * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM docs LEFT JOIN words USING (r) LEFT JOIN names USING (r)
    """


def near_duplicates(size: int = 3, threshold: int = 85) -> str:
    """Links from counts of shared shingles, components by recursion."""
    words = f"coalesce(regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+'), [])"
    return f"""
    WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
    shingles AS (SELECT DISTINCT r, array_to_string(list_slice(w, p + 1, p + {size}), ' ') AS s FROM (
        SELECT r, w, unnest(range(greatest(len(w) - {size - 1}, 1))) AS p FROM docs WHERE len(w) > 0)),
    sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
    shared AS (SELECT a.r AS a, b.r AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r GROUP BY 1, 2),
    links AS (SELECT a, b FROM shared JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * common >= {threshold} * (x.n + y.n - common)),
    reach AS (SELECT r AS a, r AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    least AS (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN docs ON docs.r = reach.b GROUP BY a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM docs LEFT JOIN sizes USING (r) JOIN least USING (r)
    """
