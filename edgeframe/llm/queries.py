"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers

from edgeframe.llm import (bpe, collocations, decontaminate, fertility, hilbert, importance, langid, near_dup, phrase_dedup,
                           quality, secrets, suffix_dedup, url_templates)
from edgeframe.llm.textcol import table


def op1_decontaminate(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_fertility(spark, sf_dir):
    return fertility.judged(table(spark, sf_dir, "documents"),
                            public_tokenizers.path("byte_bpe_50k.tiktoken"),
                            public_tokenizers.path("piece_bpe_32k.model"))


def op3_url_templates(spark, sf_dir):
    return url_templates.verdicts(table(spark, sf_dir, "pages"),
                                  url_templates.page_labels(table(spark, sf_dir, "labels")), url_templates.last_number())


def op4_hilbert(spark, sf_dir):
    return hilbert.placed(table(spark, sf_dir, "documents"))


def op5_quality(spark, sf_dir):
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_suffix_dedup(spark, sf_dir):
    return suffix_dedup.removed(table(spark, sf_dir, "documents"))


def op7_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_langid(spark, sf_dir):
    return langid.predictions(table(spark, sf_dir, "documents"))


def op9_near_dup(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_phrase_dedup(spark, sf_dir):
    return phrase_dedup.removed(table(spark, sf_dir, "documents"))


def op11_secrets(spark, sf_dir):
    return secrets.scanned(table(spark, sf_dir, "documents"))


def op12_importance(spark, sf_dir):
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_fertility, op3_url_templates, op4_hilbert, op5_quality, op6_suffix_dedup,
    op7_bpe, op8_langid, op9_near_dup, op10_phrase_dedup, op11_secrets, op12_importance, op13_collocations)}

_WORDS = (r"coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []::VARCHAR[])")

ORACLES = {
    "op1_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS ws FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(ws), 10) AS l, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS w
       FROM b, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) t(i) WHERE len(ws) > 0),
dw AS (SELECT rid, i, l, array_to_string(ws[i:i + l - 1], ' ') AS w
       FROM d, (SELECT DISTINCT l FROM bw) ls, unnest(range(1, len(ws) - l + 2)) t(i) WHERE len(ws) >= l),
m AS (SELECT DISTINCT rid, i, l, item FROM dw JOIN bw USING (l, w)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit
        FROM (SELECT rid, unnest(range(i, i + l)) AS p FROM m) GROUP BY rid),
it AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS s
       FROM m GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)""",
    "op6_suffix_dedup": """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
u AS (SELECT rid, doc_id, unnest(range(1, len(h) // 2 + 1)) AS p, unnest(regexp_extract_all(h, '..')) AS b,
             unnest(list_transform(range(1, len(h) // 2 + 1),
                                   lambda i: CASE WHEN i + 99 <= len(h) // 2 THEN md5(substr(h, 2 * i - 1, 200)) END)) AS s
      FROM d),
w AS (SELECT rid, p, b, s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1 AS again FROM u),
c AS (SELECT rid, p, b, bool_or(again) OVER (PARTITION BY rid ORDER BY p ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)
             AS gone FROM w),
e AS (SELECT rid, p, b, gone, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY rid ORDER BY p) AS new FROM c),
k AS (SELECT rid, count(*) FILTER (gone) AS n_removed, count(*) FILTER (new) AS n_spans,
             string_agg(b, '' ORDER BY p) FILTER (NOT gone) AS kept FROM e GROUP BY rid)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN k USING (rid)""",
    "op10_phrase_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT rid, i, row_number() OVER (PARTITION BY array_to_string(ws[i:i + 19], ' ') ORDER BY doc_id, i) > 1 AS again
      FROM d, unnest(range(1, len(ws) - 18)) t(i)),
hit AS (SELECT DISTINCT rid, unnest(range(i, i + 20)) AS p FROM w WHERE again),
n AS (SELECT rid, count(*) AS n_removed FROM hit GROUP BY rid),
u AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM d),
k AS (SELECT rid, string_agg(word, ' ' ORDER BY p) AS kept FROM u ANTI JOIN hit USING (rid, p) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN n USING (rid) LEFT JOIN k USING (rid)""",
    "op11_secrets": secrets.scan_sql(),
    # crc32 by the usual table, made from its polynomial
    "op12_importance": f"""
WITH tab AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)),
                    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT {_WORDS} AS ws FROM benchmark),
df AS (SELECT rid, ws[i] AS f FROM d, unnest(range(1, len(ws) + 1)) t(i)
       UNION ALL SELECT rid, ws[i] || ' ' || ws[i + 1] FROM d, unnest(range(1, len(ws))) t(i)),
bf AS (SELECT ws[i] AS f FROM b, unnest(range(1, len(ws) + 1)) t(i)
       UNION ALL SELECT ws[i] || ' ' || ws[i + 1] FROM b, unnest(range(1, len(ws))) t(i)),
u AS (SELECT DISTINCT f FROM (SELECT f FROM df UNION ALL SELECT f FROM bf)),
k AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(regexp_extract_all(hex(encode(f)), '..'), lambda x: ('0x' || x)::BIGINT)),
             lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS k FROM u, tab),
s AS (SELECT k, count(*) AS s FROM df JOIN k USING (f) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM bf JOIN k USING (f) GROUP BY k),
g AS (SELECT k, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM df) + 10000)
             / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bf) + 10000))))::BIGINT AS gain
      FROM (SELECT unnest(range(10000)) AS k) LEFT JOIN s USING (k) LEFT JOIN t USING (k)),
w AS (SELECT rid, count(*) AS n, sum(gain)::BIGINT AS gain FROM df JOIN k USING (f) JOIN g USING (k) GROUP BY rid),
x AS (SELECT rid, doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_features,
             coalesce((gain - ((gain % n) + n) % n) // n, 0) AS weight,
             ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM d LEFT JOIN w USING (rid)),
y AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM x),
z AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place FROM y)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= 20 AND place <= 25 * (SELECT count(*) FROM x WHERE n_words >= 20) // 100 THEN place END AS rank
FROM z""",
    "op13_collocations": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
s AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
f AS MATERIALIZED (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
      FROM s, (SELECT unnest([1, 2, 3]) AS k), unnest(range(1, len(ws) - k + 2)) t(i) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
u AS (SELECT c.*, cut, lang || chr(9) || array_to_string(w[1:cut], ' ') AS x, lang || chr(9) || array_to_string(w[cut + 1:], ' ') AS y
      FROM c, unnest(range(1, k)) t(cut)),
g AS MATERIALIZED (SELECT lang || chr(9) || phrase AS z, f FROM f WHERE f >= 10),
v AS (SELECT u.lang, u.k, u.phrase, a, cut, fx.f AS l, fy.f AS r, (1000000 * a::HUGEINT * a // (fx.f::HUGEINT * fy.f))::BIGINT AS score
      FROM u JOIN g fx ON fx.z = x JOIN g fy ON fy.z = y),
b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
o AS (SELECT lang, phrase, max(a) AS most FROM (
        SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, a FROM c, unnest([1, 2]) t(i) WHERE k = 3) GROUP BY ALL),
e AS (SELECT b.* FROM b LEFT JOIN o USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM e JOIN n USING (lang) QUALIFY rank <= 2000""",
}
