"""DuckDB SQL for the operators that SQL can express (the others are tested against brute force)."""

from __future__ import annotations

from .licenses import BASE
from .mixing import SEED

OP1 = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM sized GROUP BY source
), w AS (
  SELECT *, (CASE rk % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END) AS w, 3 * source_size AS cap FROM src
), steps AS (
  SELECT *, coalesce(sum(cap) OVER up, 0) AS full_caps, coalesce(sum(w) OVER up, 0) AS gone,
         sum(source_size) OVER () AS total, sum(w) OVER () AS all_w, row_number() OVER (ORDER BY cap / w, rk) AS k
  FROM w WINDOW up AS (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, (total - full_caps)::DOUBLE / (all_w - gone) AS own FROM steps
), level AS (
  SELECT arg_min(own, k) AS x FROM levels WHERE own * w <= cap
), targets AS (
  SELECT source, rk, source_size, total::BIGINT AS total,
         CASE WHEN x IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, x * w) END AS target FROM levels, level
), queue AS (
  SELECT s.doc_id, t.*, s.size, e.epoch,
         ('0x' || md5('{SEED}|' || e.epoch || '|' || coalesce(s.doc_id::VARCHAR, ''))[1:13])::BIGINT AS h
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source, (SELECT unnest([0, 1, 2]) AS epoch) e WHERE s.size > 0
), finish AS (
  SELECT *, sum(size) OVER (PARTITION BY rk ORDER BY epoch, h, doc_id ROWS UNBOUNDED PRECEDING) / target AS f FROM queue
), served AS (
  SELECT *, sum(size) OVER (ORDER BY f, rk, epoch, h, doc_id ROWS UNBOUNDED PRECEDING) <= total AS ok FROM finish
), copies AS (
  SELECT doc_id, count(*) FILTER (ok)::BIGINT AS copies FROM served GROUP BY doc_id
)
SELECT s.doc_id, s.size, t.source_size, t.target, CASE WHEN s.size = 0 THEN 0 ELSE c.copies * s.size END::BIGINT AS taken,
       s.source, CASE WHEN s.size = 0 THEN 1 ELSE c.copies END::BIGINT AS copies
FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN copies c ON s.doc_id = c.doc_id
"""

OP2 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP5 = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), comp AS (
  SELECT a, min(b) AS low FROM reach GROUP BY a
), n AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(c.low, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(c.low, e.vec_id) AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN comp c ON c.a = e.vec_id
"""

OP7 = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), comp AS (
  SELECT a, min(b) AS low FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(c.low, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(c.low, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN comp c ON c.a = d.doc_id
"""

_CONTROL = r"([\[<])(\\*)(/?(?:SYS\]|INST\]|ROLE[ \]]|s>))"
OP8 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), r AS (
  SELECT *, regexp_replace(text, '{_CONTROL}', '\1\\\2\3', 'g') AS body FROM t
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(body) + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
           ELSE 14 + length(role) + length(regexp_replace(role, '[^~\]\[<]', '', 'g')) END)::BIGINT AS formatted_chars,
       count(*) FILTER (body <> text)::BIGINT AS escaped_turns
FROM r GROUP BY conv_id
"""


def _phrase_starts(phrase: str) -> str:
    words = phrase.split()
    test = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(words))
    return f"list_filter(range(0, len(w)), lambda i: {test})"


# The templates of the license operator as expressions over the words joined by single spaces.
_TEMPLATES = {
    "apache-2.0": " licensed under the apache license version 2 0 ",
    "bsd": " redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met ",
    "cc-by-4.0": " licensed under (a )?(creative commons )?cc by 4 0 ",
    "cc-by-nc-4.0": " licensed under (a )?(creative commons )?cc by nc 4 0 ",
    "cc-by-sa-4.0": " licensed under (a )?(creative commons )?cc by sa 4 0 ",
    "copyright-notice": " copyright (c )?([^ ]+ ){1,8}all rights reserved ",
    "gpl-3.0": " licensed under (the terms of )?the gnu general public license (as published by ([^ ]+ ){1,6})?(either )?version 3 ",
    "mit": " under the mit license ",
    "mit-grant": " permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files (the software )?to deal in ([^ ]+ ){1,3}without restriction ",
}
OP9 = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), found AS (
  SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS line, {", ".join(f"{_phrase_starts(p)} AS p{i}" for i, p in enumerate(BASE))} FROM words
), named AS (
  SELECT *, list_concat(list_concat(p0, p1), p2) AS places,
         list_filter([{", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{x}' END" for i, x in enumerate(BASE.values()))}], lambda x: x IS NOT NULL) AS base,
         list_filter([{", ".join(f"CASE WHEN regexp_matches(line, '{p}') THEN '{x}' END" for x, p in _TEMPLATES.items())}], lambda x: x IS NOT NULL) AS more
  FROM found
)
SELECT doc_id, len(w)::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word, list_max(places)::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(base, more))), ','), '') AS labels,
       CASE WHEN len(more) > 0 THEN 1.0 WHEN len(base) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM named
"""

def _op11(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds of Lloyd's method, written out one after the other."""
    ctes = [f"""kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), part AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x FROM kept, (SELECT unnest(range({parts})) AS p)
), book0 AS MATERIALIZED (
  SELECT p, r - 1 AS e, x AS c FROM part WHERE r <= {entries}
)"""]
    for k in range(rounds + 1):
        ctes.append(f"""near{k} AS MATERIALIZED (
  SELECT r, p, x, arg_min(e, d * {entries} + e) AS e, min(d) AS d FROM (
    SELECT a.r, a.p, a.x, b.e, list_sum(list_transform(list_zip(a.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM part a JOIN book{k} b ON a.p = b.p) GROUP BY r, p, x
)""")
        if k < rounds:
            ctes.append(f"""mean{k} AS (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, e, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS m FROM (
      SELECT p, e, i, sum(y)::BIGINT AS s, count(*)::BIGINT AS n FROM (
        SELECT p, e, unnest(x) AS y, unnest(range(len(x))) AS i FROM near{k}) GROUP BY p, e, i)) GROUP BY p, e
), book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m ON m.p = b.p AND m.e = b.e
)""")
    return f"""
WITH {", ".join(ctes)}, digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM book{rounds}
), code AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY r
)
SELECT k.vec_id, c.code, c.error, sum(c.error) OVER (PARTITION BY k.label)::BIGINT AS label_error, h AS codebooks_sha256
FROM kept k JOIN code c USING (r), digest
"""


OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), pos AS (
  SELECT a, b, score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5
)
SELECT p.a AS anchor_id, p.b AS positive_id, row_number() OVER w::INT AS rank, n.b AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM pos p JOIN scored n ON p.a = n.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
WINDOW w AS (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b)
QUALIFY row_number() OVER w <= 5
"""

SQL = {"op1_mix_sources": OP1, "op2_top_k": OP2, "op5_embedding_dedup": OP5, "op7_near_duplicates": OP7,
       "op8_chat_format": OP8, "op9_license_scan": OP9, "op11_vector_codes": _op11(), "op12_hard_negatives": OP12}
