"""Registered queries of the subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

import corpus_pipeline
from sitegauge.llm import (chat, decontam, hardneg, itq, jaccard, langid, packing, quality, secretscan,
                           sentencepiece, tokalign, urltree, warc)

QUERIES = {
    "op1_url_template_tree": urltree.op1_url_template_tree,
    "op2_vector_packing": packing.op2_vector_packing,
    "op3_decontamination": decontam.op3_decontamination,
    "op4_ngram_jaccard": jaccard.op4_ngram_jaccard,
    "op5_langid_centroids": langid.op5_langid_centroids,
    "op6_chat_template": chat.op6_chat_template,
    "op7_quality_ftrl": quality.op7_quality_ftrl,
    "op8_sentencepiece": sentencepiece.op8_sentencepiece,
    "op9_itq_near_dups": itq.op9_itq_near_dups,
    "op10_warc_writer": warc.op10_warc_writer,
    "op11_secret_scan": secretscan.op11_secret_scan,
    "op12_hard_negatives": hardneg.op12_hard_negatives,
    "op13_token_alignment": tokalign.op13_token_alignment,
    "pipeline": corpus_pipeline.run,
}

def _letters(word: str) -> str:
    """A pattern of the word's ASCII letters in either case."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_ASSIGN = ("(?:" + "|".join(_letters(w) for w in ("password", "passwd", "secret", "token", "api_"))
           + "?" + _letters("key") + """)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""")
#: kind, pattern, characters that are counted, least number of them. Counts that
#: change no other match stand in the pattern.
_SECRETS = (
    ("assign", _ASSIGN, 1, 8), ("access", "AKIA[A-Z0-9]{12,}", 0, 0), ("hex", "[0-9a-f]{32,}", 0, 0),
    ("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", 0, 0),
    ("web_token", "eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 0, 40),
    ("host_token", "gh[oprsu]_[A-Za-z0-9]+", 0, 40), ("chat_token", "xox[abprs]-[A-Za-z0-9-]+", 0, 20))
#: Matches and the pieces between them give every match's place.
_SECRET_ROWS = " UNION ALL ".join(
    f"""SELECT rn, {i} AS o, '{kind}' AS kind, regexp_extract_all(x, '{p}') AS hits,
               regexp_extract_all(x, '{p}', {g}) AS counted, string_split_regex(x, '{p.replace("(", "(?:").replace("(?:?:", "(?:")}') AS gaps, {least} AS least
        FROM t WHERE regexp_matches(x, '{p}')""" for i, (kind, p, g, least) in enumerate(_SECRETS))

#: What SQL can say; the other operators train, iterate, tokenise or shard, and
#: are held against brute force in tests/llm.
_PROBE = "'<|im_end|><|im_start|>assistant ok'"
SQL: dict[str, str] = {
    "op4_ngram_jaccard": """
        WITH RECURSIVE d AS (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
             s AS (SELECT rn, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
                   ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3])) END AS sh FROM d),
             x AS (SELECT rn, unnest(sh) AS g FROM s),
             shared AS (SELECT a.rn AS a, b.rn AS b, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.rn < b.rn GROUP BY 1, 2),
             link AS (SELECT a, b FROM shared JOIN s sa ON sa.rn = a JOIN s sb ON sb.rn = b
                      WHERE 100 * c >= 85 * (len(sa.sh) + len(sb.sh) - c)),
             edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
             reach(n, m) AS (SELECT rn, rn FROM s UNION SELECT r.n, e.b FROM reach r JOIN edge e ON r.m = e.a)
        SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, o.component_id
        FROM s JOIN (SELECT n, min(t.doc_id) AS component_id FROM reach JOIN s t ON t.rn = m GROUP BY n) o ON o.n = s.rn""",
    "op6_chat_template": f"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES (-1, 0, 'user', {_PROBE}), (-1, 1, 'assistant', {_PROBE}))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length('<|im_start|>' || role || chr(10) || '<|im_end|>' || chr(10))
                        + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|'))) AS BIGINT) AS formatted_chars
        FROM t GROUP BY conv_id""",
    "op10_warc_writer": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
             d AS (SELECT page_id, n, sha256(h) AS digest,
                          CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY sha256(h)) END AS first_id FROM p)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id < page_id THEN first_id END AS refers_to FROM d""",
    "op11_secret_scan": f"""
        WITH t AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS x FROM documents),
             m AS ({_SECRET_ROWS}),
             e AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m),
             s AS (SELECT rn, o, kind, length(hits[i]) AS n,
                          CAST(list_sum(list_transform(gaps[1:i], lambda y: length(y)))
                               + coalesce(list_sum(list_transform(hits[1:i - 1], lambda y: length(y))), 0) AS BIGINT) AS a
                   FROM e WHERE length(counted[i]) >= least),
             g AS (SELECT rn, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                          count(*) FILTER (kind = 'hex') AS n_hex,
                          string_agg(kind || ':' || a || ':' || a + n, ',' ORDER BY a, o) FILTER (o < 3) AS base,
                          string_agg(kind || ':' || a || ':' || a + n, ',' ORDER BY a, o) AS spans FROM s GROUP BY rn)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN g USING (rn)""",
    "op12_hard_negatives": """
        WITH v AS (SELECT vec_id, row_number() OVER () AS rn, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.rn AS arn, a.vec_id AS anchor_id, c.rn, c.vec_id, a.label = c.label AS same,
                          CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
                   FROM v a JOIN v c ON a.rn <> c.rn AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0),
             p AS (SELECT arn, anchor_id, vec_id, score,
                          row_number() OVER (PARTITION BY arn ORDER BY score DESC, vec_id NULLS LAST, rn) AS k
                   FROM s WHERE same QUALIFY k <= 5)
        SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
               CAST(row_number() OVER (PARTITION BY p.arn, p.k ORDER BY s.score DESC, s.vec_id NULLS LAST, s.rn) AS INTEGER) AS rank
        FROM p JOIN s USING (arn) WHERE NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score QUALIFY rank <= 5""",
}
