"""The same answers in SQL, written from the definitions and not from the Spark plans.

Co-occurrence joins positions, cycles join raw edges ``k`` times, and the similarity
join compares every record with every other.
"""

from __future__ import annotations

_WORDS = r"""
docs AS (
  SELECT doc_id,
         list_filter(
           regexp_split_to_array(text, '[ \t\n\f*$&#/"''\\,.:;?!\[\](){}<>~\-_]+'),
           lambda x: x <> '') AS words
  FROM documents
),
tf AS (
  SELECT lower(word) AS term, doc_id, count(*) AS tf
  FROM (SELECT doc_id, unnest(words) AS word FROM docs)
  GROUP BY ALL
)"""

_LINES = r"""
lines AS (
  SELECT doc_id, (generate_subscripts(cut, 1) - 1)::INTEGER AS line_no, unnest(cut) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS cut FROM documents)
),
words AS (
  SELECT doc_id, line_no,
         list_filter(
           regexp_split_to_array(lower(line), '[ \t\n\x0B\f\r*$&#/"'',.:;?!\[\](){}<>~\-_]+'),
           lambda x: x <> '' AND x[1] BETWEEN 'a' AND 'z') AS words
  FROM lines
),
occ AS (
  SELECT doc_id, line_no, (generate_subscripts(words, 1) - 1)::INTEGER AS pos, unnest(words) AS token
  FROM words
),
pairs AS (
  SELECT a.token AS t1, b.token AS t2, count(*) AS n
  FROM occ a JOIN occ b
    ON a.doc_id = b.doc_id AND a.line_no = b.line_no AND a.pos < b.pos
  GROUP BY ALL
)"""

_EDGES = """
edges AS (
  SELECT src, dst FROM (
    SELECT l_partkey AS src,
           lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS dst
    FROM lineitem)
  WHERE dst IS NOT NULL
)"""

# 0.8 is the threshold; 5.01e-7 is the rounding slack of the filters.
_SETS = """
records AS (
  SELECT CASE WHEN doc_id % 2 = 0 THEN 'r' ELSE 's' END AS side, doc_id AS id, tokens
  FROM (
    SELECT doc_id,
           list_sort(list_distinct(list_filter(
             regexp_split_to_array(lower(text), '[^a-z]+'), lambda x: x <> ''))) AS tokens
    FROM documents)
  WHERE len(tokens) > 0
),
items AS (SELECT side, id, len(tokens)::INTEGER AS size, unnest(tokens) AS token FROM records),
freq AS (SELECT token, count(*) AS freq FROM items GROUP BY token),
ranked AS (
  SELECT side, id, size, token, freq,
         (row_number() OVER (PARTITION BY side, id ORDER BY freq, token))::INTEGER AS rank
  FROM items JOIN freq USING (token)
),
prefix AS (
  SELECT side, id, size, rank, token FROM ranked
  WHERE rank <= size - ceil(size * (0.8::DOUBLE - 5.01e-7)) + 1
),
similar_pairs AS (
  SELECT rid, sid, round(shared / (rsize + ssize - shared), 6) AS sim
  FROM (
    SELECT r.id AS rid, s.id AS sid, len(r.tokens) AS rsize, len(s.tokens) AS ssize,
           len(list_intersect(r.tokens, s.tokens)) AS shared
    FROM records r JOIN records s ON r.side = 'r' AND s.side = 's')
  WHERE shared > 0 AND round(shared / (rsize + ssize - shared), 6) >= 0.8::DOUBLE
)"""


def _cycles(k: int) -> str:
    """All cycles of ``k`` edges as rows ``v1 .. vk``, smallest id first, repeated per edge choice."""
    sources = ", ".join(f"edges e{i}" for i in range(1, k + 1))
    linked = [f"e{i}.dst = e{i % k + 1}.src" for i in range(1, k + 1)]
    smallest = [f"e1.src < e{i}.src" for i in range(2, k + 1)]
    different = [f"e{i}.src <> e{j}.src" for i in range(2, k + 1) for j in range(i + 1, k + 1)]
    columns = ", ".join(f"e{i}.src AS v{i}" for i in range(1, k + 1))
    return f"SELECT {columns} FROM {sources} WHERE {' AND '.join(linked + smallest + different)}"


ORACLES: dict[str, str] = {
    "tokenize_documents": f"""WITH {_WORDS}
        SELECT doc_id, (generate_subscripts(words, 1) - 1)::INTEGER AS pos, unnest(words) AS token
        FROM docs""",
    "term_frequency": f"WITH {_WORDS} SELECT term, doc_id, tf FROM tf",
    "document_frequency": f"""WITH {_WORDS}
        SELECT term, count(DISTINCT doc_id) AS df FROM tf GROUP BY term""",
    "corpus_size": "SELECT count(*) AS n_docs FROM documents",
    "tfidf_inverted_index": f"""WITH {_WORDS},
        df AS (SELECT term, count(DISTINCT doc_id) AS df FROM tf GROUP BY term)
        SELECT term, doc_id,
               round(tf * log10((SELECT count(*) FROM documents)::DOUBLE / df), 9) AS tfidf
        FROM tf JOIN df USING (term)""",
    "line_tokens": f"WITH {_LINES} SELECT doc_id, line_no, pos, token FROM occ",
    "cooccurrence_counts": f"WITH {_LINES} SELECT t1, t2, n FROM pairs",
    "cooccurrence_totals": f"""WITH {_LINES}
        SELECT t1, sum(n)::BIGINT AS n FROM pairs GROUP BY t1""",
    "relative_term_frequency": f"""WITH {_LINES}
        SELECT t1, t2, n::DOUBLE / (sum(n) OVER (PARTITION BY t1))::DOUBLE AS freq FROM pairs""",
    "graph_edges": f"WITH {_EDGES} SELECT src, dst FROM edges",
    "graph_vertices": f"""WITH {_EDGES}
        SELECT src AS vertex FROM edges UNION SELECT dst FROM edges""",
    "simple_paths_k3": f"""WITH {_EDGES}
        SELECT a.src AS v1, b.src AS v2, b.dst AS v3, count(*) AS n
        FROM edges a JOIN edges b ON a.dst = b.src
        WHERE a.src <> b.src AND b.src <> b.dst AND a.src <> b.dst
        GROUP BY ALL""",
    "cycles_k3": f"""WITH {_EDGES}
        SELECT v1, v2, v3, count(*) AS n FROM ({_cycles(3)}) GROUP BY ALL""",
    "cycle_count_k2": f"WITH {_EDGES} SELECT count(*) AS n_cycles FROM ({_cycles(2)})",
    "cycle_count_k3": f"WITH {_EDGES} SELECT count(*) AS n_cycles FROM ({_cycles(3)})",
    "cycle_count_k4": f"WITH {_EDGES} SELECT count(*) AS n_cycles FROM ({_cycles(4)})",
    # Two paths of two edges and a closing edge, counted by distinct edges.
    "cycle_count_k5": f"""WITH {_EDGES},
        known AS (SELECT src, dst, count(*) AS n FROM edges WHERE src <> dst GROUP BY ALL),
        two AS (
          SELECT a.src AS v1, a.dst AS v2, b.dst AS v3, a.n * b.n AS n
          FROM known a JOIN known b ON a.dst = b.src AND a.src <> b.dst)
        SELECT coalesce(sum(p.n * q.n * c.n), 0)::BIGINT AS n_cycles
        FROM two p JOIN two q ON p.v3 = q.v1 JOIN known c ON c.src = q.v3 AND c.dst = p.v1
        WHERE p.v1 < p.v2 AND p.v1 < p.v3 AND p.v1 < q.v2 AND p.v1 < q.v3
          AND p.v2 <> q.v2 AND p.v2 <> q.v3""",
    "record_token_sets": f"""WITH {_SETS}
        SELECT side, id, array_to_string(tokens, ' ') AS tokens FROM records""",
    "token_frequency": f"WITH {_SETS} SELECT token, freq FROM freq",
    "canonical_token_order": f"WITH {_SETS} SELECT side, id, rank, token, freq FROM ranked",
    "prefix_tokens": f"WITH {_SETS} SELECT side, id, size, rank, token FROM prefix",
    "similarity_candidates": f"""WITH {_SETS}
        SELECT DISTINCT r.id AS rid, s.id AS sid
        FROM prefix r JOIN prefix s ON r.token = s.token AND r.side = 'r' AND s.side = 's'
        WHERE s.size >= r.size * (0.8::DOUBLE - 5.01e-7)
          AND r.size >= s.size * (0.8::DOUBLE - 5.01e-7)""",
    "set_similarity_join": f"WITH {_SETS} SELECT rid, sid, sim FROM similar_pairs",
    "similarity_report": f"""WITH {_SETS}
        SELECT row_number() OVER (ORDER BY rid, sid) AS line_no,
               '(' || rid || ',' || sid || ')' || chr(9) || sim AS value
        FROM similar_pairs""",
    "postings_report": f"""WITH {_WORDS},
        df AS (SELECT term, count(DISTINCT doc_id) AS df FROM tf GROUP BY term)
        SELECT row_number() OVER (ORDER BY term, doc_id) AS line_no, term, doc_id,
               round(tf * log10((SELECT count(*) FROM documents)::DOUBLE / df), 9) AS tfidf
        FROM tf JOIN df USING (term)""",
    "relative_frequency_report": f"""WITH {_LINES},
        shares AS (
          SELECT t1, t2, n::DOUBLE / (sum(n) OVER (PARTITION BY t1))::DOUBLE AS freq FROM pairs)
        SELECT row_number() OVER (ORDER BY t1, freq DESC, t2) AS line_no, t1, t2, freq FROM shares""",
    "read_documents": r"""
        SELECT doc_id, (generate_subscripts(words, 1) - 1)::INTEGER AS pos, unnest(words) AS token
        FROM (
          SELECT doc_id,
                 list_filter(
                   regexp_split_to_array(
                     translate(text, chr(13) || chr(10), '  '),
                     '[ \t\n\f*$&#/"''\\,.:;?!\[\](){}<>~\-_]+'),
                   lambda x: x <> '') AS words
          FROM documents)""",
    "read_edges": "SELECT l_orderkey AS edge_id, l_partkey AS src, l_suppkey AS dst FROM lineitem",
    "read_token_sets": """
        SELECT doc_id AS id,
               unnest(list_distinct(list_filter(
                 string_split(translate(text, chr(13) || chr(10), '  '), ' '), lambda x: x <> ''))) AS token
        FROM documents""",
}
# What was saved and read back is the report.
for _saved, _report in (
    ("saved_postings", "postings_report"),
    ("saved_relative_frequencies", "relative_frequency_report"),
    ("saved_similarities", "similarity_report"),
):
    ORACLES[_saved] = ORACLES[_report]
