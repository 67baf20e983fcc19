"""
not from the Spark code. Each query gets the view CTEs it needs.

Orders that must agree between engines use ``md5('<seed>|<id>')`` with the
id as tiebreak; both engines produce the same lowercase hex digest.
"""

from __future__ import annotations

VIEWS = {
    "catalogue": """
catalogue AS (
  SELECT c.c_custkey AS File_index,
    'https://units.example.org/unit_' || CAST(c.c_custkey AS VARCHAR) || '.csv.gz' AS Download_Link,
    CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'human' WHEN 'BUILDING' THEN 'mouse'
      WHEN 'FURNITURE' THEN 'mouse_BALB/c' WHEN 'HOUSEHOLD' THEN 'rat' ELSE 'rabbit' END AS Species,
    n.n_name || ' et al., ' || CAST(n.n_nationkey + 2000 AS VARCHAR) AS Author,
    'PBMC' AS BSource,
    CASE c.c_custkey % 3 WHEN 0 THEN 'Naive-B-Cells' WHEN 1 THEN 'Memory-B-Cells'
      ELSE 'Unsorted-B-Cells' END AS BType,
    'no' AS Longitudinal,
    CASE WHEN c.c_custkey % 13 = 0 THEN 'no' ELSE CAST(c.c_custkey % 60 + 18 AS VARCHAR) END AS Age,
    CASE WHEN c.c_custkey % 4 = 0 THEN 'SARS-COV-2' ELSE 'None' END AS Disease,
    CASE WHEN c.c_custkey % 10 = 0 THEN 'no'
      ELSE 'Subject-' || CAST(c.c_custkey % 40 AS VARCHAR) END AS Subject,
    'None' AS Vaccine,
    CASE WHEN c.c_custkey % 2 = 0 THEN 'Heavy' ELSE 'Light' END AS Chain,
    CASE c.c_custkey % 5 WHEN 0 THEN 'IGHG' WHEN 1 THEN 'IGHM' WHEN 2 THEN 'IGHA'
      WHEN 3 THEN 'Bulk' END AS Isotype,
    CASE WHEN c.c_custkey % 17 = 0 THEN 'n/a'
      ELSE CAST(CAST(floor(abs(c.c_acctbal)) AS BIGINT) AS VARCHAR) END AS Unique_sequences,
    CASE WHEN c.c_custkey % 17 = 0 THEN 'n/a'
      ELSE CAST(2 * CAST(floor(abs(c.c_acctbal)) AS BIGINT) AS VARCHAR) END AS Total_sequences,
    CAST(abs(CAST(c.c_acctbal AS DECIMAL(18,2))) / 100 AS DECIMAL(18,4)) AS Size_MB
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)""",
    "sequences": """
sequences AS (SELECT o_orderkey AS Sequence_ID, o_custkey AS File_ID FROM orders)""",
    "residues": """
doc_lines AS (
  SELECT doc_id, lang, source, unnest(range(len(parts))) AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS parts FROM documents)),
doc_res AS (
  SELECT doc_id, lang, source, line_no,
    regexp_replace(upper(regexp_replace(line, '[^A-Za-z]', '', 'g')),
                   '[^ACDEFGHIKLMNPQRSTVWY]', '', 'g') AS s
  FROM doc_lines),
residues AS (
  SELECT doc_id * 100000 + line_no AS Sequence_ID,
    TRY_CAST(regexp_extract(source, '([0-9]+)', 1) AS BIGINT) AS File_ID,
    CASE lang WHEN 'en' THEN 'H' WHEN 'fr' THEN 'K' ELSE 'L' END AS locus,
    nullif(substr(s, 1, 25), '') AS fwr1_aa,
    nullif(substr(s, 26, 8), '') AS cdr1_aa,
    nullif(substr(s, 34, 17), '') AS fwr2_aa,
    nullif(substr(s, 51, 8), '') AS cdr2_aa,
    nullif(substr(s, 59, 38), '') AS fwr3_aa,
    nullif(substr(s, 97, 14), '') AS cdr3_aa,
    nullif(substr(s, 111), '') AS fwr4_aa,
    'IGHV' || CAST(doc_id % 7 + 1 AS VARCHAR) AS v_call,
    'IGHD' || CAST(line_no % 5 + 1 AS VARCHAR) AS d_call,
    'IGHJ' || CAST(doc_id % 6 + 1 AS VARCHAR) AS j_call,
    CAST(line_no % 20 + 1 AS INTEGER) AS Redundancy,
    s AS sequence
  FROM doc_res WHERE length(s) > 0)""",
    "losses": """
losses AS (
  SELECT event_type AS model, 'set' || CAST(user_id % 4 AS VARCHAR) AS test_set,
    CAST(event_id % 3 AS INTEGER) AS "rank", event_id AS batch, value AS loss FROM events)""",
}

# individual key of a catalogue row (Subject, or no_<Author with \W+ -> _>)
INDIVIDUAL = ("CASE WHEN Subject = 'no' THEN 'no_' || regexp_replace(Author, '\\W+', '_', 'g') "
              "ELSE Subject END")
MD5_ORDER = "md5('42|' || CAST(Sequence_ID AS VARCHAR)), Sequence_ID"


def with_views(sql: str, *views: str, extra: str = "", recursive: bool = False) -> str:
    ctes = [VIEWS[v].strip() for v in views]
    if extra:
        ctes.append(extra.strip())
    body = sql.strip()
    head = "WITH RECURSIVE " if recursive else "WITH "
    if body.upper().startswith("WITH "):   # merge the query's own CTEs
        return head + ",\n".join(ctes) + ",\n" + body[5:]
    return head + ",\n".join(ctes) + "\n" + body


ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str, *views: str, extra: str = "", recursive: bool = False) -> None:
    ORACLES[name] = with_views(sql, *views, extra=extra, recursive=recursive)


# ---------------------------------------------------------------- catalogue
oracle("select_units", """
SELECT File_index, Download_Link FROM catalogue
WHERE Species IN ('human', 'mouse') AND Chain IN ('Heavy')
  AND TRY_CAST(Unique_sequences AS DOUBLE) >= 1000 AND TRY_CAST(Unique_sequences AS DOUBLE) <= 8000
""", "catalogue")

oracle("rows_per_file", """
SELECT File_ID AS File_index, count(*) AS row_count FROM sequences GROUP BY File_ID
""", "sequences")

oracle("rows_per_subject", """
SELECT m.Subject, sum(r.row_count) AS row_count
FROM (SELECT File_ID AS File_index, count(*) AS row_count FROM sequences GROUP BY File_ID) r
LEFT JOIN (SELECT File_index, Subject FROM catalogue WHERE File_index IS NOT NULL AND Subject IS NOT NULL) m
  ON r.File_index = m.File_index
WHERE m.Subject IS NOT NULL
GROUP BY m.Subject HAVING sum(r.row_count) > 350
""", "sequences", "catalogue")

oracle("read_catalogue", """
SELECT File_index, Species, Author, Subject, Chain, Isotype,
  TRY_CAST(Unique_sequences AS BIGINT) AS Unique_sequences,
  TRY_CAST(Total_sequences AS BIGINT) AS Total_sequences,
  CAST(Size_MB AS DOUBLE) AS Size_MB
FROM catalogue
""", "catalogue")

oracle("coerce_counts", """
SELECT File_index,
  COALESCE(TRY_CAST(Unique_sequences AS BIGINT), 0) AS Unique_sequences,
  COALESCE(TRY_CAST(Total_sequences AS BIGINT), 0) AS Total_sequences,
  TRY_CAST(Age AS DOUBLE) AS Age
FROM catalogue
""", "catalogue")

oracle("sanitize_names", """
SELECT DISTINCT Author,
  regexp_replace(Author, '\\W+', '_', 'g') AS author_word,
  translate(Author, ' ,:;.', '_') AS author_file
FROM catalogue
""", "catalogue")

oracle("size_by_author", """
SELECT Author, CAST(sum(Size_MB) AS DOUBLE) AS Size_MB FROM catalogue
WHERE Author IS NOT NULL GROUP BY Author
""", "catalogue")

oracle("total_by_author", """
SELECT Author, COALESCE(sum(TRY_CAST(Total_sequences AS BIGINT)), 0) AS Total_sequences
FROM catalogue WHERE Author IS NOT NULL GROUP BY Author
""", "catalogue")

oracle("unique_by_author", """
SELECT Author, COALESCE(sum(TRY_CAST(Unique_sequences AS BIGINT)), 0) AS Unique_sequences
FROM catalogue WHERE Author IS NOT NULL GROUP BY Author
""", "catalogue")

oracle("unique_by_subject", """
SELECT Subject, Author, COALESCE(sum(TRY_CAST(Unique_sequences AS BIGINT)), 0) AS Unique_sequences
FROM catalogue WHERE Subject IS NOT NULL AND Author IS NOT NULL GROUP BY Subject, Author
""", "catalogue")

oracle("unique_by_subject_human", """
SELECT Subject, Author, COALESCE(sum(TRY_CAST(Unique_sequences AS BIGINT)), 0) AS Unique_sequences
FROM catalogue WHERE Species = 'human' AND Subject IS NOT NULL AND Author IS NOT NULL
GROUP BY Subject, Author
""", "catalogue")

oracle("unique_by_species_chain", """
SELECT Species, Chain, COALESCE(sum(TRY_CAST(Unique_sequences AS BIGINT)), 0) AS Unique_sequences
FROM catalogue WHERE Species IS NOT NULL AND Chain IS NOT NULL GROUP BY Species, Chain
""", "catalogue")

oracle("unique_by_species", """
SELECT Species, COALESCE(sum(TRY_CAST(Unique_sequences AS BIGINT)), 0) AS Unique_sequences
FROM catalogue WHERE Species IS NOT NULL GROUP BY Species
""", "catalogue")

oracle("species_chain_pivot", """
SELECT Species,
  COALESCE(sum(CASE WHEN Chain = 'Heavy' THEN TRY_CAST(Unique_sequences AS BIGINT) END), 0) AS Heavy,
  COALESCE(sum(CASE WHEN Chain = 'Light' THEN TRY_CAST(Unique_sequences AS BIGINT) END), 0) AS Light
FROM catalogue WHERE Species IS NOT NULL AND Chain IS NOT NULL GROUP BY Species
""", "catalogue")

_ISO = """
SELECT Isotype, sum(u) AS Total_Unique_Sequences, sum(t) AS Total_Total_Sequences,
  CASE WHEN sum(sum(u)) OVER () > 0 THEN round(sum(u) / sum(sum(u)) OVER () * 100, 6) ELSE 0.0 END
    AS Percentage_Unique_Sequences,
  CASE WHEN sum(sum(t)) OVER () > 0 THEN round(sum(t) / sum(sum(t)) OVER () * 100, 6) ELSE 0.0 END
    AS Percentage_Total_Sequences
FROM (SELECT Isotype, COALESCE(TRY_CAST(Unique_sequences AS BIGINT), 0) AS u,
             COALESCE(TRY_CAST(Total_sequences AS BIGINT), 0) AS t
      FROM catalogue WHERE {where}) x
WHERE Isotype IS NOT NULL GROUP BY Isotype
"""
oracle("isotype_stats_all", _ISO.format(where="TRUE"), "catalogue")
oracle("isotype_stats_human", _ISO.format(where="Species = 'human'"), "catalogue")
oracle("isotype_stats_mouse", _ISO.format(
    where="Species IN ('mouse_C57BL/6', 'mouse_BALB/c', 'mouse', 'Kymouse', 'HIS-Mouse', "
          "'mouse_RAG2-GFP/129Sve', 'mouse_Swiss-Webster')"), "catalogue")

oracle("author_count", "SELECT count(DISTINCT Author) AS author_count FROM catalogue", "catalogue")
oracle("authors", "SELECT DISTINCT Author FROM catalogue", "catalogue")
oracle("authors_without_subject",
       "SELECT DISTINCT Author FROM catalogue WHERE Subject = 'no'", "catalogue")
oracle("subjects_in_many_publications", """
SELECT Subject, count(DISTINCT Author) AS n_publications,
  array_to_string(list_sort(list(DISTINCT Author)), '; ') AS publications
FROM catalogue WHERE Subject IS NOT NULL AND Author IS NOT NULL
GROUP BY Subject HAVING count(DISTINCT Author) > 1
""", "catalogue")
oracle("total_size", """
SELECT CAST(sum(Size_MB) AS DOUBLE) AS total_mb,
  round(CAST(sum(Size_MB) AS DOUBLE) / 1024, 6) AS total_gb,
  round(CAST(sum(Size_MB) AS DOUBLE) / 1024 / 1024, 9) AS total_tb
FROM catalogue
""", "catalogue")
oracle("subject_size_histogram", """
WITH sizes AS (
  SELECT Subject, Author, COALESCE(sum(TRY_CAST(Unique_sequences AS BIGINT)), 0) AS size
  FROM catalogue WHERE Subject IS NOT NULL AND Author IS NOT NULL GROUP BY Subject, Author),
bins(bin, lower, upper) AS (VALUES (0, 0.0, 100.0), (1, 100.0, 1000.0), (2, 1000.0, 10000.0),
  (3, 10000.0, 100000.0), (4, 100000.0, 1000000.0), (5, 1000000.0, 10000000.0),
  (6, 10000000.0, 'inf'::DOUBLE))
SELECT b.bin, b.lower, b.upper, CAST(count(s.size) AS BIGINT) AS n_subjects
FROM bins b LEFT JOIN sizes s ON s.size > b.lower AND s.size <= b.upper
GROUP BY b.bin, b.lower, b.upper
""", "catalogue")
oracle("age_histogram", """
WITH d AS (SELECT TRY_CAST(Age AS DOUBLE) AS age, TRY_CAST(Unique_sequences AS BIGINT) AS w
           FROM catalogue),
f AS (SELECT * FROM d WHERE age IS NOT NULL AND w IS NOT NULL),
r AS (SELECT CASE WHEN min(age) = max(age) THEN min(age) - 0.5 ELSE min(age) END AS lo,
             CASE WHEN min(age) = max(age) THEN max(age) + 0.5 ELSE max(age) END AS hi FROM f),
b AS (SELECT CAST(least(floor((age - lo) / (hi - lo) * 20), 19) AS INTEGER) AS bin, lo, hi, w
      FROM f, r)
SELECT CAST(g.i AS INTEGER) AS bin, round(r.lo + (r.hi - r.lo) * g.i / 20, 6) AS lower,
  round(r.lo + (r.hi - r.lo) * (g.i + 1) / 20, 6) AS upper,
  CAST((SELECT coalesce(sum(w), 0) FROM b WHERE b.bin = g.i) AS BIGINT) AS unique_sequences
FROM range(20) g(i), r WHERE r.lo IS NOT NULL
""", "catalogue")

# ------------------------------------------------------------ groups/joins
_GROUPED_SEQS = """
grouped AS (
  SELECT s.Sequence_ID, s.File_ID, {key} AS group_key
  FROM sequences s JOIN catalogue c ON s.File_ID = c.File_index
  WHERE {key} IS NOT NULL)"""

oracle("sequences_per_publication", """
SELECT group_key AS Author, count(*) AS n_sequences FROM grouped GROUP BY group_key
""", "sequences", "catalogue", extra=_GROUPED_SEQS.format(key="c.Author"))


oracle("partition_by_publication", """
SELECT 'publication_' || translate(group_key, ' ,:;.', '_') || '.csv' AS Filename,
  count(*) AS Number_of_sequences
FROM grouped GROUP BY group_key
""", "sequences", "catalogue", extra=_GROUPED_SEQS.format(key="c.Author"))

_IND_SEQS = _GROUPED_SEQS.format(
    key=INDIVIDUAL.replace("Subject", "c.Subject").replace("Author", "c.Author"))
oracle("partition_by_individual", """
SELECT 'individual_' || group_key || '.csv' AS Filename, count(*) AS Number_of_sequences
FROM grouped GROUP BY group_key
""", "sequences", "catalogue", extra=_IND_SEQS)
oracle("group_size_overview", """
SELECT 'individual_' || group_key || '.csv' AS Filename, count(*) AS Number_of_sequences
FROM grouped GROUP BY group_key
""", "sequences", "catalogue", extra=_IND_SEQS)

# ------------------------------------------------------- sampling / splits
oracle("sample_exact", f"""
SELECT Sequence_ID, File_ID FROM (
  SELECT *, row_number() OVER (ORDER BY {MD5_ORDER}) AS rk FROM sequences) t
WHERE rk <= 1000
""", "sequences")

_BALANCED = f"""
SELECT Sequence_ID, File_ID, group_key FROM (
  SELECT *, row_number() OVER (PARTITION BY group_key ORDER BY {MD5_ORDER}) AS rk,
    CAST(ceil({{total}} / count(DISTINCT group_key) OVER ()) AS BIGINT) AS quota
  FROM grouped) t
WHERE rk <= quota
"""
oracle("sample_balanced_individuals", _BALANCED.format(total="300.0"),
       "sequences", "catalogue", extra=_IND_SEQS)
oracle("sample_balanced_publications", _BALANCED.format(total="500.0"),
       "sequences", "catalogue", extra=_GROUPED_SEQS.format(key="c.Author"))
oracle("publication_adequacy", """
SELECT group_key AS Author, count(*) AS n_sequences,
  CAST(ceil(500.0 / count(*) OVER ()) AS BIGINT) AS needed,
  count(*) < ceil(500.0 / count(*) OVER ()) AS is_short
FROM grouped GROUP BY group_key
""", "sequences", "catalogue", extra=_GROUPED_SEQS.format(key="c.Author"))

# Round robin from its definition: the p-th row (file order) of a group is
# drawn in round p; within a round groups go by name; stop after N draws.
_RR = """
rr AS (
  SELECT Sequence_ID, File_ID, group_key FROM (
    SELECT *, row_number() OVER (ORDER BY p, group_key) AS draw FROM (
      SELECT *, row_number() OVER (PARTITION BY group_key ORDER BY Sequence_ID) AS p
      FROM grouped) a) b
  WHERE draw <= 5000)"""
oracle("sample_round_robin", "SELECT * FROM rr", "sequences", "catalogue",
       extra=_IND_SEQS + ",\n" + _RR.strip())
oracle("sampling_distribution", """
SELECT g.group_key, CAST(count(rr.Sequence_ID) AS BIGINT) AS n_sampled
FROM (SELECT DISTINCT group_key FROM grouped) g LEFT JOIN rr ON g.group_key = rr.group_key
GROUP BY g.group_key
""", "sequences", "catalogue", extra=_IND_SEQS + ",\n" + _RR.strip())

_SPLIT = f"""
SELECT Sequence_ID, File_ID,
  CASE WHEN rk <= {{t}} THEN 'train' WHEN rk <= {{t}} + {{v}} THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY {MD5_ORDER}) AS rk,
             count(*) OVER () AS n FROM sequences) s
WHERE rk <= {{cap}}
"""
oracle("split_numbers", _SPLIT.format(t="1000", v="100", cap="n"), "sequences")
oracle("split_fraction", _SPLIT.format(t="floor(0.8 * n)", v="floor(0.1 * n)", cap="n"),
       "sequences")
oracle("split_capped", _SPLIT.format(t="1000", v="100", cap="1200"), "sequences")
oracle("kfold", """
SELECT Sequence_ID, File_ID,
  CAST(CASE WHEN rk <= r * (q + 1) THEN (rk - 1) // (q + 1)
            ELSE r + (rk - 1 - r * (q + 1)) // q END AS INTEGER) AS fold
FROM (SELECT *, row_number() OVER (ORDER BY Sequence_ID) AS rk,
             count(*) OVER () // 5 AS q, count(*) OVER () % 5 AS r FROM sequences) s
""", "sequences")

# ------------------------------------------------- residues and encoding
_REGIONS = ["fwr1_aa", "cdr1_aa", "fwr2_aa", "cdr2_aa", "fwr3_aa", "cdr3_aa", "fwr4_aa"]
_TEXT = "concat(" + ", ".join(f"coalesce({r}, '')" for r in _REGIONS) + ")"

oracle("keep_columns", """
SELECT Sequence_ID, File_ID, locus, fwr1_aa, cdr1_aa, fwr2_aa, cdr2_aa, fwr3_aa, cdr3_aa, fwr4_aa,
  v_call, d_call, j_call, Redundancy FROM residues
""", "residues")


def _len_ok(col, lo, hi, blank_check=True):
    s = f"{col} IS NOT NULL AND length({col}) BETWEEN {lo} AND {hi}"
    return s + (f" AND NOT regexp_matches({col}, '^\\s*$')" if blank_check else "")


oracle("region_length_ingest", "SELECT Sequence_ID, File_ID, " + ", ".join(_REGIONS)
       + " FROM residues WHERE " + " AND ".join([
           _len_ok("fwr1_aa", 20, 50), _len_ok("fwr4_aa", 10, 50), _len_ok("cdr1_aa", 5, 12),
           _len_ok("cdr2_aa", 1, 10), _len_ok("cdr3_aa", 5, 38)]), "residues")

_SECOND = " AND ".join([f"{r} IS NOT NULL" for r in _REGIONS] + [
    _len_ok("fwr1_aa", 20, 200, False), _len_ok("cdr1_aa", 5, 12, False),
    _len_ok("cdr2_aa", 1, 10, False), _len_ok("cdr3_aa", 5, 38, False),
    _len_ok("fwr4_aa", 10, 200, False)])
oracle("region_length_second", "SELECT Sequence_ID, File_ID, " + ", ".join(_REGIONS)
       + " FROM residues WHERE " + _SECOND, "residues")

oracle("sequence_text", f"SELECT Sequence_ID, File_ID, {_TEXT} AS text FROM residues", "residues")

# Token ids: letters of the vocabulary in id order from 5; unknown -> 3.
_VOCAB_LETTERS = "['A','C','D','E','F','G','H','I','K','L','M','N','P','Q','R','S','T','V','W','Y']"
_TOKENS = f"""
tok AS (
  SELECT Sequence_ID, [0] || list_transform(
      list_filter(string_split({_TEXT}, ''), lambda c: c <> '')[1:148],
      lambda c: coalesce(list_position({_VOCAB_LETTERS}, c) + 4, 3)) || [2] AS seq
  FROM residues),
tok2 AS (
  SELECT Sequence_ID, seq || list_transform(range(150 - len(seq)), lambda i: 1) AS ids,
    list_transform(range(150), lambda i: CASE WHEN i < len(seq) THEN 1 ELSE 0 END) AS att,
    list_transform(range(150), lambda i: CASE WHEN i = 0 OR i >= len(seq) - 1 THEN 1 ELSE 0 END) AS spc
  FROM tok)"""
oracle("tokenize", """
SELECT Sequence_ID, CAST(to_json(ids) AS VARCHAR) AS input_ids,
  CAST(to_json(att) AS VARCHAR) AS attention_mask,
  CAST(to_json(spc) AS VARCHAR) AS special_tokens_mask FROM tok2
""", "residues", extra=_TOKENS)

# Masking: h = fmix64(((id << 8) | pos) xor (42 * golden) mod 2^64); the
# three uniforms are 21-bit fields of h at shifts 43, 22 and 1.
_SEEDMIX = (42 * 0x9E3779B97F4A7C15) % 2 ** 64


def _mul(x, c):
    return (f"CAST(((CAST({x} AS UHUGEINT) * CAST({c} AS UHUGEINT)) "
            f"% CAST(18446744073709551616 AS UHUGEINT)) AS UBIGINT)")


_MASK_CTE = f"""
pos AS (
  SELECT Sequence_ID, p, ids[p + 1] AS x, spc[p + 1] AS sp,
    xor((CAST(Sequence_ID AS UBIGINT) << 8) | CAST(p AS UBIGINT), CAST({_SEEDMIX} AS UBIGINT)) AS k0
  FROM tok2, unnest(range(150)) AS r(p)),
h1 AS (SELECT *, {_mul("xor(k0, k0 >> 33)", 0xFF51AFD7ED558CCD)} AS k1 FROM pos),
h2 AS (SELECT *, {_mul("xor(k1, k1 >> 33)", 0xC4CEB9FE1A85EC53)} AS k2 FROM h1),
h3 AS (SELECT *, xor(k2, k2 >> 33) AS h FROM h2),
u AS (SELECT *, ((h >> 43) & 2097151) / 2097152.0 AS u1, ((h >> 22) & 2097151) / 2097152.0 AS u2,
        ((h >> 1) & 2097151) / 2097152.0 AS u3 FROM h3),
m AS (SELECT Sequence_ID, p, x, sp = 0 AND u1 < 0.15 AS sel, u2, u3 FROM u)"""
oracle("mlm_mask", """
SELECT Sequence_ID,
  CAST(to_json(list(CASE WHEN sel AND u2 < 0.8 THEN 4
                            WHEN sel AND u2 < 0.9 THEN CAST(floor(u3 * 25) AS INTEGER)
                            ELSE x END ORDER BY p)) AS VARCHAR) AS input_ids,
  CAST(to_json(list(CASE WHEN sel THEN x ELSE -100 END ORDER BY p)) AS VARCHAR) AS labels
FROM m GROUP BY Sequence_ID
""", "residues", extra=_TOKENS + ",\n" + _MASK_CTE.strip())

# Numbering text per FIXTURES: keys are '<n><A or space>'; the sorted base
# numbers are the digits of every key (text broken for every 11th id -> NULL).
oracle("numbering_positions", f"""
SELECT Sequence_ID, array_to_string(pos, ',') AS anarci_list, len(pos) AS n_positions FROM (
  SELECT Sequence_ID, CASE WHEN Sequence_ID % 11 = 0 THEN NULL ELSE list_sort(list_transform(
      list_transform(range(length(fwr1_aa)), lambda i: i + 1) ||
      list_transform(range(length(cdr3_aa)), lambda i: i + 105), lambda x: CAST(x AS INTEGER))) END AS pos
  FROM residues WHERE {_SECOND}) t
""", "residues")

oracle("fasta_records", f"""
SELECT Sequence_ID, '>Sequence_' || CAST(Sequence_ID AS VARCHAR) || chr(10) || {_TEXT} AS record FROM residues
""", "residues")
oracle("fasta_ids", "SELECT Sequence_ID FROM residues", "residues")

# ------------------------------------------------------------- clustering
# k = 10, m = 20 smallest k-mer keys, identity 90 %, coverage 90 %. Key of a
# k-mer: residues packed 5 bits each (alphabet position), xor (42 * golden),
# fmix64, shifted right by one (fits a BIGINT).
_PACKED = " | ".join(
    f"(CAST(strpos('ACDEFGHIKLMNPQRSTVWY', substr(sequence, i + {j}, 1)) - 1 AS UBIGINT) << {5 * (9 - j)})"
    for j in range(10))
_K0 = f"xor({_PACKED}, CAST({_SEEDMIX} AS UBIGINT))"
KMER_KEY = "k_key"
_CLUSTER = """
uniq AS (SELECT min(Sequence_ID) AS rep_id, sequence, length(sequence) AS len, count(*) AS n_copies
         FROM residues GROUP BY sequence),
kw AS (SELECT rep_id AS id, len, sequence, unnest(range(1, len - 10 + 2)) AS i
       FROM uniq WHERE len >= 10),
k0 AS (SELECT id, len, i, """ + _K0 + """ AS k0 FROM kw),
k1 AS (SELECT id, len, i, """ + _mul("xor(k0, k0 >> 33)", 0xFF51AFD7ED558CCD) + """ AS k1 FROM k0),
k2 AS (SELECT id, len, i, """ + _mul("xor(k1, k1 >> 33)", 0xC4CEB9FE1A85EC53) + """ AS k2 FROM k1),
km AS (SELECT id, len, CAST(xor(k2, k2 >> 33) >> 1 AS BIGINT) AS kmer, min(i) - 1 AS place FROM k2 GROUP BY 1, 2, 3),
sk AS (SELECT id, len, kmer, place FROM (
         SELECT *, row_number() OVER (PARTITION BY id ORDER BY kmer) AS rn FROM km) y WHERE rn <= 20),
centres AS (SELECT kmer, id AS centre, len AS c_len, place AS c_place FROM (
         SELECT *, row_number() OVER (PARTITION BY kmer ORDER BY len DESC, id) AS rn FROM sk) z
         WHERE rn = 1),
cand AS (SELECT DISTINCT c.centre, s.id AS member, c.c_len, s.len AS m_len, c.c_place - s.place AS diagonal
         FROM sk s JOIN centres c ON s.kmer = c.kmer WHERE s.id <> c.centre),
-- the member's residues opposite the centre on the diagonal, without gaps
ali AS (SELECT p.*, greatest(-diagonal, 0) AS m_from, greatest(diagonal, 0) AS c_from,
          least(m_len, c_len - diagonal) - greatest(-diagonal, 0) AS aligned FROM cand p),
cov AS (SELECT a.*, aligned - hamming(substr(c.sequence, c_from + 1, aligned), substr(m.sequence, m_from + 1, aligned)) AS matches
        FROM ali a JOIN uniq c ON a.centre = c.rep_id JOIN uniq m ON a.member = m.rep_id
        WHERE aligned * 10 >= m_len * 9),
pairs AS (SELECT centre, member, c_len, m_len, aligned, matches FROM (
          SELECT *, row_number() OVER (PARTITION BY centre, member ORDER BY matches DESC, aligned) AS rn
          FROM cov WHERE matches * 10 >= aligned * 9) q WHERE rn = 1)"""
oracle("exact_duplicates", "SELECT rep_id, len, n_copies FROM uniq", "residues", extra=_CLUSTER)
oracle("kmer_sketch", "SELECT id, len, kmer, place FROM sk", "residues", extra=_CLUSTER)
oracle("kmer_candidates", "SELECT centre, member, c_len, m_len, diagonal FROM cand", "residues", extra=_CLUSTER)
oracle("verified_pairs", """SELECT centre, member, c_len, m_len, aligned, matches FROM pairs""", "residues", extra=_CLUSTER)

# Greedy cover, sequential form of the definition: walk the sequences that
# have a verified pair in priority order (length desc, id asc); one becomes a
# representative unless a verified higher-priority neighbour already is one.
# A member joins its highest-priority representative neighbour; every other
# unique sequence represents itself, and exact copies follow their first id.
_COVER = _CLUSTER + """,
vp AS (SELECT centre AS src, member AS dst FROM pairs),
inv AS (SELECT src AS id FROM vp UNION SELECT dst FROM vp),
ins AS (SELECT dst AS id, list(src) AS ins FROM vp GROUP BY dst),
nodes AS (SELECT u.rep_id AS id, coalesce(i.ins, []::BIGINT[]) AS ins,
            row_number() OVER (ORDER BY u.len DESC, u.rep_id) AS pos
          FROM uniq u JOIN inv v ON u.rep_id = v.id LEFT JOIN ins i ON i.id = u.rep_id),
walk(pos, reps) AS (
  SELECT CAST(0 AS BIGINT), []::BIGINT[]
  UNION ALL
  SELECT n.pos, CASE WHEN list_has_any(w.reps, n.ins) THEN w.reps
                     ELSE list_append(w.reps, n.id) END
  FROM walk w JOIN nodes n ON n.pos = w.pos + 1),
greedy_reps AS (SELECT unnest(reps) AS id FROM walk WHERE pos = (SELECT max(pos) FROM walk)),
best AS (SELECT id, rep FROM (
           SELECT vp.dst AS id, vp.src AS rep,
             row_number() OVER (PARTITION BY vp.dst ORDER BY u.len DESC, vp.src) AS rn
           FROM vp JOIN greedy_reps g ON vp.src = g.id JOIN uniq u ON u.rep_id = vp.src) b
         WHERE rn = 1),
cover AS (SELECT u.rep_id AS id, coalesce(b.rep, u.rep_id) AS rep
          FROM uniq u LEFT JOIN best b ON b.id = u.rep_id),
assigned AS (SELECT r.Sequence_ID, c.rep AS rep_id
             FROM residues r JOIN uniq u ON r.sequence = u.sequence JOIN cover c ON c.id = u.rep_id)"""
oracle("cluster_assignments", "SELECT Sequence_ID, rep_id FROM assigned", "residues",
       extra=_COVER, recursive=True)
oracle("cluster_representatives", "SELECT DISTINCT rep_id FROM assigned", "residues",
       extra=_COVER, recursive=True)
oracle("cluster_sizes", "SELECT rep_id, count(*) AS size FROM assigned GROUP BY rep_id",
       "residues", extra=_COVER, recursive=True)
oracle("representatives", """
SELECT Sequence_ID, File_ID, locus, fwr1_aa, cdr1_aa, fwr2_aa, cdr2_aa, fwr3_aa, cdr3_aa, fwr4_aa,
  v_call, d_call, j_call, Redundancy FROM residues
WHERE Sequence_ID IN (SELECT rep_id FROM assigned)
""", "residues", extra=_COVER, recursive=True)

# ----------------------------------------------------------------- ingest
# A unit per residue File_ID: line 1 metadata, line 2 header, then the rows
# in Sequence_ID order (v_call written as two comma-separated alleles).
_UNIT_ROWS = """
unit_rows AS (
  SELECT *, v_call || '*01,' || v_call || '*02' AS v_call_full,
    row_number() OVER (PARTITION BY File_ID ORDER BY Sequence_ID) + 2 AS line
  FROM residues)"""
_KEEP = ("locus, fwr1_aa, cdr1_aa, fwr2_aa, cdr2_aa, fwr3_aa, cdr3_aa, fwr4_aa, "
         "v_call_full AS v_call, d_call, j_call, Redundancy")
_INGEST_OK = " AND ".join([
    _len_ok("fwr1_aa", 20, 50), _len_ok("fwr4_aa", 10, 50), _len_ok("cdr1_aa", 5, 12),
    _len_ok("cdr2_aa", 1, 10), _len_ok("cdr3_aa", 5, 38)])
oracle("read_units", """
SELECT File_ID, line, locus, v_call_full AS v_call, fwr1_aa, cdr1_aa, fwr2_aa, cdr2_aa, fwr3_aa,
  cdr3_aa, fwr4_aa, Redundancy FROM unit_rows
""", "residues", extra=_UNIT_ROWS)
oracle("assign_sequence_ids", f"""
SELECT row_number() OVER (ORDER BY File_ID, line) AS Sequence_ID, File_ID, {_KEEP}
FROM unit_rows WHERE {_INGEST_OK}
""", "residues", extra=_UNIT_ROWS)
oracle("every_nth", f"""
SELECT row_number() OVER (ORDER BY File_ID, line) AS Sequence_ID, File_ID, {_KEEP} FROM (
  SELECT *, row_number() OVER (PARTITION BY File_ID ORDER BY line) AS pos
  FROM unit_rows WHERE {_INGEST_OK}) f
WHERE pos % 3 = 0
""", "residues", extra=_UNIT_ROWS)
oracle("ingest_unfiltered", f"""
SELECT row_number() OVER (ORDER BY File_ID, line) AS Sequence_ID, File_ID, {_KEEP} FROM unit_rows
""", "residues", extra=_UNIT_ROWS)

oracle("unit_manifest", """
SELECT File_ID, '"{""Run"": ""unit_' || CAST(File_ID AS VARCHAR) || '"", ""Species"": ""human"", ""Chain"": ""Heavy""}"' AS first_line, count(*) + 2 AS n_lines,
  sum(strlen(row_text) + 1) + strlen('"{""Run"": ""unit_' || CAST(File_ID AS VARCHAR) || '"", ""Species"": ""human"", ""Chain"": ""Heavy""}"') + 1 + 1230 AS bytes,
  round((sum(strlen(row_text) + 1) + strlen('"{""Run"": ""unit_' || CAST(File_ID AS VARCHAR) || '"", ""Species"": ""human"", ""Chain"": ""Heavy""}"') + 1 + 1230) / 1048576.0, 4) AS Size_MB
FROM (SELECT File_ID, concat_ws(',', CASE WHEN regexp_matches(sequence, '[,"]') THEN '"' || replace(sequence, '"', '""') || '"' ELSE coalesce(sequence, '') END, CASE WHEN regexp_matches(locus, '[,"]') THEN '"' || replace(locus, '"', '""') || '"' ELSE coalesce(locus, '') END, '', '', '', '', '', '', CASE WHEN regexp_matches(v_call_full, '[,"]') THEN '"' || replace(v_call_full, '"', '""') || '"' ELSE coalesce(v_call_full, '') END, CASE WHEN regexp_matches(d_call, '[,"]') THEN '"' || replace(d_call, '"', '""') || '"' ELSE coalesce(d_call, '') END, CASE WHEN regexp_matches(j_call, '[,"]') THEN '"' || replace(j_call, '"', '""') || '"' ELSE coalesce(j_call, '') END, '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', CASE WHEN regexp_matches(fwr1_aa, '[,"]') THEN '"' || replace(fwr1_aa, '"', '""') || '"' ELSE coalesce(fwr1_aa, '') END, '', CASE WHEN regexp_matches(cdr1_aa, '[,"]') THEN '"' || replace(cdr1_aa, '"', '""') || '"' ELSE coalesce(cdr1_aa, '') END, '', CASE WHEN regexp_matches(fwr2_aa, '[,"]') THEN '"' || replace(fwr2_aa, '"', '""') || '"' ELSE coalesce(fwr2_aa, '') END, '', CASE WHEN regexp_matches(cdr2_aa, '[,"]') THEN '"' || replace(cdr2_aa, '"', '""') || '"' ELSE coalesce(cdr2_aa, '') END, '', CASE WHEN regexp_matches(fwr3_aa, '[,"]') THEN '"' || replace(fwr3_aa, '"', '""') || '"' ELSE coalesce(fwr3_aa, '') END, '', CASE WHEN regexp_matches(fwr4_aa, '[,"]') THEN '"' || replace(fwr4_aa, '"', '""') || '"' ELSE coalesce(fwr4_aa, '') END, '', CASE WHEN regexp_matches(cdr3_aa, '[,"]') THEN '"' || replace(cdr3_aa, '"', '""') || '"' ELSE coalesce(cdr3_aa, '') END, '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', '', CASE WHEN regexp_matches(CAST(Redundancy AS VARCHAR), '[,"]') THEN '"' || replace(CAST(Redundancy AS VARCHAR), '"', '""') || '"' ELSE coalesce(CAST(Redundancy AS VARCHAR), '') END, '', CASE WHEN regexp_matches('|', '[,"]') THEN '"' || replace('|', '"', '""') || '"' ELSE coalesce('|', '') END) AS row_text FROM unit_rows) r GROUP BY File_ID
""", "residues", extra=_UNIT_ROWS)

# ------------------------------------------------------- catalogue lines
_FIELDS = ["Species", "Author", "Subject", "Chain", "Isotype", "Age"]
_RAW = """
raw AS (
  SELECT 'wget ' || Download_Link || ', "' || replace(js, '"', '""') || '"' ||
    CASE WHEN File_index % 29 = 0 THEN '' ELSE ', ' || CAST(Size_MB AS VARCHAR) || ' MB' END AS value
  FROM (SELECT *, '{' || concat_ws(', ', """ + ", ".join(
    f"""'"{f}": "' || coalesce({f}, '') || '"'""" for f in _FIELDS) + """,
      CASE WHEN File_index % 7 = 0 THEN '"Extra": "x"' END) ||
      CASE WHEN File_index % 23 = 0 THEN '' ELSE '}' END AS js FROM catalogue) c),
parsed AS (
  SELECT value, regexp_matches(trim(value), '^wget (\\S+), "(.*?)", ([\\d.]+) MB$') AS ok,
    regexp_extract(trim(value), '^wget (\\S+), "(.*?)", ([\\d.]+) MB$', 1) AS link,
    replace(regexp_extract(trim(value), '^wget (\\S+), "(.*?)", ([\\d.]+) MB$', 2), '""', '"') AS j,
    regexp_extract(trim(value), '^wget (\\S+), "(.*?)", ([\\d.]+) MB$', 3) AS size
  FROM raw)"""
oracle("parse_catalogue_lines", "SELECT link AS Download_Link, " + ", ".join(
    f"json_extract_string(j, '$.{f}') AS {f}" for f in _FIELDS)
    + ", CAST(TRY_CAST(size AS DECIMAL(18,4)) AS DOUBLE) AS Size_MB FROM parsed WHERE ok AND json_valid(j)",
    "catalogue", extra=_RAW)
oracle("bad_catalogue_lines", """
SELECT trim(value) AS line, CASE WHEN NOT ok THEN 'invalid line' ELSE 'malformed json' END AS reason
FROM parsed WHERE NOT ok OR NOT json_valid(j)
""", "catalogue", extra=_RAW)
oracle("labelled_groups", """
SELECT Author, s AS Unique_sequences, CASE WHEN s > 250000 THEN Author ELSE '' END AS label FROM (
  SELECT Author, COALESCE(sum(TRY_CAST(Unique_sequences AS BIGINT)), 0) AS s
  FROM catalogue WHERE Author IS NOT NULL GROUP BY Author) a
""", "catalogue")

# ------------------------------------------------------------ assessment
_PER_SET = """
per_rank AS (
  SELECT model, test_set, "rank", CAST(sum(CAST(loss AS DECIMAL(38,12))) AS DOUBLE) / count(*) AS rm,
    count(*) AS n
  FROM losses WHERE loss IS NOT NULL AND NOT isnan(loss) GROUP BY model, test_set, "rank"),
per_set AS (
  SELECT model, test_set, round(avg(rm), 6) AS eval_loss, sum(n) AS n_batches
  FROM per_rank GROUP BY model, test_set)"""
oracle("loss_by_test_set", """
SELECT model, test_set, eval_loss, n_batches,
  CASE WHEN eval_loss <= 709 THEN CAST(printf('%.9e', exp(eval_loss)) AS DOUBLE) END AS perplexity FROM per_set
""", "losses", extra=_PER_SET)
oracle("loss_matrix", """
SELECT model,
  max(CASE WHEN test_set = 'set0' THEN eval_loss END) AS set0,
  max(CASE WHEN test_set = 'set1' THEN eval_loss END) AS set1,
  max(CASE WHEN test_set = 'set2' THEN eval_loss END) AS set2,
  max(CASE WHEN test_set = 'set3' THEN eval_loss END) AS set3,
  round((max(CASE WHEN test_set = 'set0' THEN eval_loss END) + max(CASE WHEN test_set = 'set1' THEN eval_loss END)
    + max(CASE WHEN test_set = 'set2' THEN eval_loss END)) / 3, 6) AS macro_mean
FROM per_set GROUP BY model
""", "losses", extra=_PER_SET)

# ---------------------------------------------------------- corpus / tokens
_SPLIT_RES = f"""
split_res AS (
  SELECT Sequence_ID, sequence AS text,
    CASE WHEN rk <= floor(0.8 * n) THEN 'train' WHEN rk <= floor(0.8 * n) + floor(0.1 * n) THEN 'val'
         ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY {MD5_ORDER}) AS rk, count(*) OVER () AS n
        FROM residues) r)"""
oracle("read_corpus", "SELECT split, text FROM split_res", "residues", extra=_SPLIT_RES)
oracle("tokenized_test_split", """
SELECT t.Sequence_ID, CAST(to_json(ids) AS VARCHAR) AS input_ids,
  CAST(to_json(att) AS VARCHAR) AS attention_mask, CAST(to_json(spc) AS VARCHAR) AS special_tokens_mask
FROM tok2 t JOIN split_res s ON t.Sequence_ID = s.Sequence_ID WHERE s.split = 'test'
""", "residues", extra=_SPLIT_RES + ",\n" + _TOKENS.strip())
oracle("token_shards", """
SELECT split, shard, count(*) AS n_rows, min(Sequence_ID) AS first_id, max(Sequence_ID) AS last_id FROM (
  SELECT split, Sequence_ID,
    CAST((row_number() OVER (PARTITION BY split ORDER BY Sequence_ID) - 1) // 500 AS INTEGER) AS shard
  FROM split_res) s
GROUP BY split, shard
""", "residues", extra=_SPLIT_RES)
oracle("split_tables", "SELECT Sequence_ID, split, text AS sequence FROM split_res", "residues", extra=_SPLIT_RES)
oracle("sequence_lines", f"SELECT {_TEXT} AS text FROM residues", "residues")
oracle("fasta_file_ids", "SELECT Sequence_ID FROM residues", "residues")
oracle("units_present_all", """
SELECT File_index, Author FROM catalogue WHERE File_index IN (SELECT File_ID FROM sequences)
""", "sequences", "catalogue")
oracle("publication_file_rows", """
SELECT 'publication_' || translate(group_key, ' ,:;.', '_') || '.csv' AS group_file, Sequence_ID, File_ID
FROM grouped
""", "sequences", "catalogue", extra=_GROUPED_SEQS.format(key="c.Author"))
ORACLES["sample_scheme_publications"] = ORACLES["sample_balanced_publications"]

_SUM = "CAST(coalesce(sum(TRY_CAST({c} AS BIGINT)), 0) AS BIGINT)"
_MB = "CAST(coalesce(sum(CAST(Size_MB AS DECIMAL(38, 4))), 0) AS DOUBLE)"
_REPORTS = [("size_by_author", ["Author"], None, "true"), ("total_by_author", ["Author"], "Total_sequences", "true"),
            ("unique_by_author", ["Author"], "Unique_sequences", "true"),
            ("unique_by_subject", ["Subject", "Author"], "Unique_sequences", "true"),
            ("unique_by_subject_human", ["Subject", "Author"], "Unique_sequences", "Species = 'human'"),
            ("unique_by_species_chain", ["Species", "Chain"], "Unique_sequences", "true"),
            ("unique_by_species", ["Species"], "Unique_sequences", "true"), ("total_size", [], None, "true")]
oracle("catalogue_report", " UNION ALL ".join(
    f"SELECT '{name}' AS report, {keys[0] if keys else 'NULL'} AS key_1, {keys[1] if keys[1:] else 'NULL'} AS key_2, "
    f"{_SUM.format(c=col) if col else 'NULL::BIGINT'} AS total, {_MB if not col else 'NULL::DOUBLE'} AS size_mb "
    f"FROM catalogue WHERE {' AND '.join([where] + [f'{k} IS NOT NULL' for k in keys])}"
    + (f" GROUP BY {', '.join(keys)}" if keys else "") for name, keys, col, where in _REPORTS), "catalogue")

# ------------------------------------------------------------------- sinks
# A written-and-read-back table equals the table that was written.
ORACLES["write_sequences"] = with_views("SELECT Sequence_ID, File_ID FROM sequences", "sequences")
ORACLES["committed_sequences"] = ORACLES["write_sequences"]
ORACLES["reused_row_counts"] = ORACLES["rows_per_file"]
ORACLES["metrics_json"] = ORACLES["loss_by_test_set"]
ORACLES["report_csv"] = ORACLES["unique_by_author"]
ORACLES["cached_row_counts"] = ORACLES["rows_per_file"]
ORACLES["download_list"] = ORACLES["select_units"]
ORACLES["sample_scheme_random"] = ORACLES["sample_exact"]
ORACLES["sample_scheme_individuals"] = ORACLES["sample_balanced_individuals"]
