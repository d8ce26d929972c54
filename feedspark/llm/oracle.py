"""DuckDB SQL for the queries that SQL can express, written from their rules."""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: crc32 of a number's decimal digits (null: of nothing), bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
                        [4294967295] || list_transform(range(1, length(coalesce({0}::VARCHAR, '')) + 1),
                                                       lambda i: ascii(substring({0}::VARCHAR, i, 1))::BIGINT),
                        lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                                                 lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))))"""

ORACLE_SQL = {
    "op3_exact_dedup_bloom": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                          sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
                   FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
               row_number() OVER w = 1 AS kept, h AS text_sha256
        FROM d WINDOW w AS (PARTITION BY h ORDER BY length(t) DESC, doc_id NULLS LAST)""",
    "op5_perspective_rotation": r"""
        WITH t AS (SELECT conv_id, coalesce(role, 'unknown') AS who, coalesce(text, '') AS said,
                          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                                             coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS k
                   FROM conversations),
        p AS (SELECT DISTINCT conv_id, who AS perspective FROM t WHERE who <> 'system'),
        r AS (SELECT t.conv_id, perspective, k // 64 AS block, k, said, who = perspective AS mine,
                     CASE WHEN who = perspective THEN '<|assistant|>' WHEN who = 'system' THEN '<|system|>'
                          ELSE '<|user name=' || who || '|>' END || chr(10) AS head
              FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
        o AS (SELECT *, coalesce(sum(length(head) + length(said) + 1) OVER
                     (PARTITION BY conv_id, perspective, block ORDER BY k
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(head) AS pos FROM r)
        SELECT conv_id, perspective, block::BIGINT AS block, count(*) AS n_turns,
               string_agg(head || said || chr(10), '' ORDER BY k) AS rendered,
               coalesce(string_agg(pos || ':' || (pos + length(said)), ',' ORDER BY k) FILTER (mine), '') AS mask_spans
        FROM o GROUP BY 1, 2, 3""",
    "op8_ngram_jaccard": rf"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS MATERIALIZED (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                                WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                                ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]
                                                    FOR i IN range(1, len(w) - 1)]) END AS g FROM d),
        e AS MATERIALIZED (SELECT doc_id, unnest(g) AS x FROM s),
        n AS MATERIALIZED (SELECT doc_id, len(g) AS n FROM s),
        c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
              FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS MATERIALIZED (
            SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
            WHERE 100 * shared >= 90 * (na.n + nb.n - shared)),
        u AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r AS (SELECT doc_id, doc_id AS link FROM n UNION SELECT r.doc_id, u.b FROM r JOIN u ON u.a = r.link)
        SELECT r.doc_id, any_value(n.n)::BIGINT AS n_shingles, min(link) AS component_id
        FROM r JOIN n ON n.doc_id = r.doc_id GROUP BY 1""",
    "op13_merkle_manifest": rf"""
        WITH RECURSIVE d AS (
            SELECT doc_id, source, lang, n_chars, text,
                   CASE WHEN {_CRC32.format("doc_id")} % 3 = 0 THEN translate(text, '{_UPPER}', '{_UPPER.lower()}')
                        ELSE text END AS now
            FROM documents),
        f AS (
            SELECT doc_id, lang, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
                || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
                || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                coalesce(strlen(text) || ':' || text, '-') AS was, coalesce(strlen(now) || ':' || now, '-') AS is_now
            FROM d),
        l AS MATERIALIZED (
            SELECT doc_id, lang, sha256(head || was) AS leaf, sha256(head || is_now) AS now,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256(head || was)) - 1 AS pos
            FROM f),
        node AS (
            SELECT 0 AS lv, lang, pos, leaf AS digest, count(*) OVER (PARTITION BY lang) AS width FROM l
            UNION ALL
            SELECT any_value(lv) + 1, lang, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)),
                   (any_value(width) + 7) // 8
            FROM node WHERE width > 1 GROUP BY lang, pos // 8),
        nodes AS MATERIALIZED (SELECT * FROM node),
        runs AS MATERIALIZED (
            SELECT lv, lang, pos // 8 AS up, list(digest ORDER BY pos) AS run FROM nodes WHERE width > 1
            GROUP BY lv, lang, pos // 8),
        s AS MATERIALIZED (
            SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) AS g,
                   list(digest) OVER (ORDER BY lang NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS run
            FROM nodes WHERE width = 1),
        climb AS (
            SELECT 0 AS lv, doc_id, lang, pos AS leaf_pos, pos, now AS cur, '' AS proof FROM l
            UNION ALL
            SELECT c.lv + 1, doc_id, c.lang, leaf_pos, pos // 8,
                   sha256(array_to_string(run[:pos % 8] || [cur] || run[pos % 8 + 2:], '')),
                   proof || array_to_string(run[:pos % 8] || run[pos % 8 + 2:], '')
            FROM climb c JOIN runs r ON r.lv = c.lv AND r.up = c.pos // 8 AND r.lang IS NOT DISTINCT FROM c.lang),
        topped AS (
            SELECT lang, leaf_pos, arg_max(cur, lv) AS cur, arg_max(proof, lv) AS proof FROM climb GROUP BY 1, 2)
        SELECT l.doc_id, l.leaf, s.subroot, sha256(array_to_string(s.run, '')) AS root,
               sha256(t.proof || array_to_string(s.run[:g - 1] || s.run[g + 1:], '')) AS proof_sha256,
               sha256(array_to_string(s.run[:g - 1] || [t.cur] || s.run[g + 1:], '')) AS folded_root,
               folded_root = root AS verified
        FROM l JOIN topped t ON t.leaf_pos = l.pos AND t.lang IS NOT DISTINCT FROM l.lang
        JOIN s ON s.lang IS NOT DISTINCT FROM l.lang""",
    "op11_phrase_collocations": rf"""
        WITH t AS (SELECT coalesce(lang, 'und') AS lang, doc_id,
                          unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                                       '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
        g AS (SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
              FROM w, range(1, 6) AS ks(k) WHERE len(w) >= k),
        f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY 1, 2, 3 HAVING count(*) >= 100),
        n AS MATERIALIZED (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY 1),
        c AS MATERIALIZED (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
        inside AS (SELECT c.lang, array_to_string(w[i:i + j - 1], ' ') AS phrase, max(a) AS a
                   FROM c, range(2, 5) AS js(j), range(1, 5) AS si(i) WHERE j < k AND i + j - 1 <= k GROUP BY 1, 2),
        cuts AS (SELECT c.lang, c.phrase, a, w, cut, array_to_string(w[:cut], ' ') AS lp, array_to_string(w[cut + 1:], ' ') AS rp
                 FROM c, range(1, 5) AS cs(cut)
                 WHERE cut < k AND NOT EXISTS (FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.a >= 100 * c.a)),
        s AS (SELECT u.lang, u.phrase, u.a, l.a AS l, r.a AS r, n.n, cut,
                     ((1000::HUGEINT * u.a * n.n) // (l.a::HUGEINT * r.a))::BIGINT AS score
              FROM cuts u JOIN f l ON l.lang = u.lang AND l.phrase = u.lp JOIN f r ON r.lang = u.lang AND r.phrase = u.rp
              JOIN n ON n.lang = u.lang),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, score
        FROM b QUALIFY rank <= 2000""",
}
