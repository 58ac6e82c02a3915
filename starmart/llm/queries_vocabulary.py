"""Registered queries of packing, collocations and spelling variants, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .packing import pack_documents
from .phrases import collocations
from .variants import spelling_variants


def read_vocabulary(path: str | None = None) -> str:
    """Text of a tokenizer's vocabulary file; by default that of the installed package."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"), read_vocabulary())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "window", "step")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM (
    SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM split, (VALUES (1), (2), (3), (4)) AS s(size))),
f AS (SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY lang, size, phrase HAVING count(*) >= 30),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(n) AS most FROM (
    SELECT lang, w, n, m, unnest(range(1, size - m + 2)) AS i FROM (
      SELECT lang, string_split(phrase, ' ') AS w, size, n, unnest(range(2, size)) AS m FROM f WHERE size > 2))
  GROUP BY 1, 2),
kept AS (
  SELECT f.* FROM f LEFT JOIN inside USING (lang, phrase)
  WHERE size > 1 AND (most IS NULL OR 100 * most::HUGEINT < 80 * n::HUGEINT)),
cuts AS (
  SELECT lang, phrase, n AS a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest FROM (
    SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM kept)),
scored AS (
  SELECT c.*, x.n AS l, y.n AS r, ((2000000 * a::HUGEINT) // (x.n::HUGEINT + y.n::HUGEINT))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = head JOIN f y ON y.lang = c.lang AND y.phrase = rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, total.n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


#: crc32 is spelled out: a table of 256 remainders, then one step per byte.
OP13_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT list(list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
              lambda c, y: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY x) AS step
  FROM range(256) AS r(x)),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]{7,}')) AS run FROM documents)),
bytes AS (
  SELECT run, count(*) AS n, flatten(list_transform(string_split(id || ':' || run, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END))::BIGINT[] AS b
  FROM runs GROUP BY id, run),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce([4294967295::BIGINT] || b, lambda c, y: xor(c >> 8, step[(xor(c, y) & 255) + 1]))) AS h FROM bytes, steps),
spelled AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
cut AS (SELECT word, n, i, left(word, (i - 1)::INT) || substr(word, i + 1) AS less FROM places),
pairs AS (
  SELECT a.word, b.word AS near, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN cut b ON a.word = b.less
  UNION SELECT b.word, a.word, a.n FROM words a JOIN cut b ON a.word = b.less),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS near, max(n) AS near_n FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, CASE WHEN near_n >= 10 * n THEN near END AS form, n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN near_n >= 10 * n THEN near_n END AS form_n FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, form AS up FROM forms
  UNION ALL SELECT chain.word, forms.word, forms.form FROM chain JOIN forms ON forms.word = chain.up)
SELECT forms.word, forms.form, chain.root, forms.n, forms.n_near, forms.form_n FROM forms JOIN chain ON chain.word = forms.word AND chain.up IS NULL
"""

QUERIES = {"op11_packing": op11_packing, "op12_phrases": op12_phrases, "op13_variants": op13_variants}
ORACLE_SQL = {"op12_phrases": OP12_SQL, "op13_variants": OP13_SQL}
