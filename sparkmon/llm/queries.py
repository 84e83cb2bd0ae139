"""The operators over their whole tables, and SQL for those that SQL can express."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkmon.llm.alignment import alignment_digests
from sparkmon.llm.conversations import damage, repair_report
from sparkmon.llm.decontaminate import contamination
from sparkmon.llm.fingerprints import fingerprints
from sparkmon.llm.html_text import page_texts
from sparkmon.llm.licenses import license_scan
from sparkmon.llm.mixing import mix, rating_weights
from sparkmon.llm.near_duplicates import near_duplicate_groups
from sparkmon.llm.packing import pack_documents
from sparkmon.llm.quality import graded, quality
from sparkmon.llm.shipping import ship
from sparkmon.llm.substring_dedup import without_repeats
from sparkmon.llm.token_files import read_documents, write_ids
from sparkmon.llm.tokens import tokenizer_path
from sparkmon.llm.toxicity import toxicity
from sparkmon.session import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]

#: File, separating special token, whether white space belongs to the next piece, end id.
FILE_VOCABULARY = ("word_bpe_49k.json", "<|startoftext|>", False, 2)
PACK_VOCABULARY = ("byte_bpe_50k.json", "<|endoftext|>", True, 0)
#: Byte-level file, special token of it, sentence piece file.
ALIGNED_VOCABULARIES = ("byte_bpe_50k.json", "<|endoftext|>", "piece_bpe_32k.model")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(table(spark, folder, "documents")).drop("kept_text")


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_dir(spark, "token-files")
    name, mark, spaced, end_id = FILE_VOCABULARY
    write_ids(table(spark, folder, "documents"), path, tokenizer_path(name), mark, spaced, end_id)
    return read_documents(spark, path)


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    grades = graded(table(spark, folder, "labels"))
    return quality(table(spark, folder, "documents"), grades)


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    name, mark, spaced, end_id = PACK_VOCABULARY
    return pack_documents(
        table(spark, folder, "documents"), tokenizer_path(name), mark, spaced, end_id
    )


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return page_texts(table(spark, folder, "pages"))


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_groups(table(spark, folder, "documents"))


def op10_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints(table(spark, folder, "documents"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair_report(damage(table(spark, folder, "conversations")))


def op12_mixing(spark: SparkSession, folder: str) -> DataFrame:
    quality = rating_weights(table(spark, folder, "labels"))
    return mix(table(spark, folder, "documents"), quality)


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    name_a, mark, name_b = ALIGNED_VOCABULARIES
    return alignment_digests(
        table(spark, folder, "documents"), tokenizer_path(name_a), mark, tokenizer_path(name_b)
    )


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_token_files": op3_token_files,
    "op4_decontaminate": op4_decontaminate,
    "op5_quality": op5_quality,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_html_text": op8_html_text,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_fingerprints": op10_fingerprints,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_mixing": op12_mixing,
    "op13_alignment": op13_alignment,
}

DECONTAMINATE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS words
  FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
spots AS (
  SELECT row, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM (SELECT row, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size)),
hits AS (SELECT DISTINCT row, i, s.size, item FROM spots s JOIN windows v ON s.size = v.size AND s.words = v.words),
words_hit AS (
  SELECT row, count(DISTINCT p) AS n_hit
  FROM (SELECT row, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT row, i, size FROM hits)) GROUP BY row),
held AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, item FROM hits WHERE item IS NOT NULL) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN words_hit USING (row) LEFT JOIN held USING (row)
"""

SUBSTRING_DEDUP_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
spots AS MATERIALIZED (
  SELECT row, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT row, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)),
firsts AS (SELECT h, min(doc_id) AS low FROM spots GROUP BY h),
gone AS (
  SELECT row, list(DISTINCT p) AS p
  FROM (SELECT row, unnest(range(i, i + 50)) AS p FROM spots JOIN firsts USING (h) WHERE low < doc_id) GROUP BY row),
rest AS (
  SELECT row, doc_id, w, coalesce(len(p), 0) AS n,
    CASE WHEN p IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(p, i)) END AS kept
  FROM docs LEFT JOIN gone USING (row))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_removed,
  sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM rest
"""

NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN len(w) || ':' || array_to_string(w, ' ')
    ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL) p
  JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b
  WHERE 100 * common >= 85 * (m.n + n.n - common)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM docs
  UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM docs d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""

MIXING_SQL = r"""
WITH ratings AS (SELECT doc_id, avg(quality) AS rating FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
sized AS (
  SELECT d.doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CASE WHEN rating > 0.5 THEN 2e0 WHEN rating < 0.5 THEN 0.5e0 ELSE 1e0 END AS quality_weight
  FROM documents d LEFT JOIN ratings USING (doc_id)),
drawn AS (
  SELECT *, -ln((CAST('0x' || substring(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)
    + 0.5e0) / 4503599627370496e0) / quality_weight AS sample_key FROM sized),
sources AS (
  SELECT source, source_size, 3 * source_size AS bound,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)),
ranked AS (
  SELECT *, sum(bound) OVER w - bound AS bound_before, sum(weight) OVER w - weight AS weight_before FROM sources
  WINDOW w AS (ORDER BY bound / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT max(CAST((SELECT sum(source_size) FROM sources) - bound_before AS DOUBLE) /
    ((SELECT sum(weight) FROM sources) - weight_before)) AS level FROM ranked),
targets AS (SELECT source, source_size, least(CAST(bound AS DOUBLE), level * weight) AS target FROM sources, level),
placed AS (
  SELECT d.*, source_size, target, coalesce(CAST(floor(target / nullif(source_size, 0)) AS BIGINT), 0) AS epochs,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY sample_key, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS size_before
  FROM drawn d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, quality_weight, size, source_size, target,
  size * (epochs + CASE WHEN size_before + size / 2 <= target - epochs * source_size THEN 1 ELSE 0 END) AS taken
FROM placed
"""


def _before(cost: int | str, letters: str, value: str) -> str:
    """A cost of nine digits and an audit, with an edit in front: the least text is the cheapest repair."""
    return f"(lpad(CAST(CAST(left({value}, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || '{letters}' || {value}[10:])"


def _repair_steps() -> tuple[str, str]:
    """Least values before a row, first without and then with insertions in front of it."""
    follows = {"v0": {"s": "vs", "u": "vu"}, "vs": {"u": "vu"}, "vu": {"a": "va"}, "va": {"u": "vu"}}
    inserted = {"v0": "vu", "vs": "vu", "vu": "va", "va": "vu"}
    extra = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    taken, filled = [], []
    for state, kept in follows.items():
        keep = " ".join(f"WHEN '{c}' THEN {_before(extra, 'K', after)}" for c, after in kept.items())
        rerole = _before(f"3 + {extra}", "R", inserted[state])
        stays = f"CASE WHEN fault NOT IN ('blank', 'duplicate') THEN least(CASE c {keep} END, {rerole}) END"
        taken.append(f"least({_before(4, 'D', state)}, {stays}) AS {state}")
        one, two = inserted[state], inserted[inserted[state]]
        filled.append(f"least({state}, {_before(3, 'I', one)}, {_before(6, 'II', two)}) AS {state}")
    return ", ".join(taken), ", ".join(filled)


_TAKEN, _FILLED = _repair_steps()

CONVERSATION_REPAIR_SQL = rf"""
WITH RECURSIVE raw AS MATERIALIZED (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, row_number() OVER () AS place,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
checks(place, i, crc) AS (
  SELECT place, 1, 4294967295::BIGINT FROM raw
  UNION ALL
  SELECT place, i + 1, list_reduce(list_prepend(xor(crc, ascii(substring(name, i, 1))::BIGINT), range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)
  FROM checks JOIN raw USING (place) WHERE i <= length(name)),
kinds AS (SELECT place, xor(arg_max(crc, i), 4294967295::BIGINT) % 20 AS kind FROM checks GROUP BY place),
after_damage AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM raw JOIN kinds USING (place))),
ordered AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS held, left(role, 1) AS c,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM after_damage),
rows_ AS MATERIALIZED (
  SELECT *, lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair, CASE WHEN held = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(held, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM ordered),
back(conv_id, i, v0, vs, vu, va) AS (
  SELECT conv_id, count(*), '000000000', '000000006II', '000000003I', '000000000' FROM rows_ GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i - 1, {_FILLED} FROM (
    SELECT conv_id, i, {_TAKEN} FROM (
      SELECT b.*, f.c, f.fault FROM back b JOIN rows_ f ON b.conv_id IS NOT DISTINCT FROM f.conv_id AND b.i = f.i))),
found AS (SELECT conv_id, CAST(left(v0, 9) AS BIGINT) AS cost, v0[10:] AS audit FROM back WHERE i = 0),
letters AS (
  SELECT conv_id, unnest(string_split(audit, '')) AS letter, unnest(range(1, length(audit) + 1)) AS p FROM found WHERE audit <> ''),
counted AS (
  SELECT *, count(*) FILTER (WHERE letter <> 'I') OVER w AS i, count(*) FILTER (WHERE letter <> 'D') OVER w AS kept
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
messages AS (
  SELECT l.*, r.text, r.role, bool_or(letter = 'K' AND c = 's') OVER (PARTITION BY l.conv_id) AS headed
  FROM counted l LEFT JOIN rows_ r ON l.conv_id IS NOT DISTINCT FROM r.conv_id AND l.i = r.i AND letter <> 'I'
  WHERE letter <> 'D'),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role
    WHEN (kept + CASE WHEN headed THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
    coalesce(text, ''), chr(10) ORDER BY p) AS text FROM messages GROUP BY conv_id),
faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM rows_ GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(t.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM raw) d
LEFT JOIN faults a ON d.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN found f ON d.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN texts t ON d.conv_id IS NOT DISTINCT FROM t.conv_id
"""

ORACLES: dict[str, str] = {
    "op2_substring_dedup": SUBSTRING_DEDUP_SQL,
    "op4_decontaminate": DECONTAMINATE_SQL,
    "op9_near_duplicates": NEAR_DUPLICATES_SQL,
    "op11_conversation_repair": CONVERSATION_REPAIR_SQL,
    "op12_mixing": MIXING_SQL,
}
