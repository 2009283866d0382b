"""DuckDB SQL for the text queries that SQL can express."""

from __future__ import annotations

from marketstream.llm import fill_in_middle, licenses, lines, queries, sharding, vector_file

#: The CRC-32 of a text's bytes, bit by bit from its polynomial; the table is made by the rule, not listed.
CRC_TABLE = """
crc_table AS (
  SELECT list(list_reduce(range(9), lambda x, step: CASE WHEN step = 0 THEN x
    WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, n) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)
)"""
CRC = """xor(4294967295, list_reduce(list_transform(range(length(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::BIGINT),
    lambda s, b: xor(s >> 8, t[xor(s & 255, b) + 1]), 4294967295))"""


def op3_rendezvous_shards() -> str:
    n = queries.SHARDS
    draw = "-ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '/' || s::VARCHAR), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)"
    return f"""
WITH {CRC_TABLE.strip()}, rows AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(strlen(text), 0) + 16 AS size, hex(encode(coalesce(text, ''))) AS x
  FROM documents
), draws AS (
  SELECT r, s, {draw} AS draw FROM rows, range({n + 1}) AS shards(s)
), best AS (
  SELECT r, arg_min(s, draw) FILTER (s < {n}) AS shard, arg_min(s, draw) AS grown_shard FROM draws GROUP BY r
), crc AS (
  SELECT r, CASE WHEN x = '' THEN 0 ELSE {CRC} END AS text_crc32 FROM rows, crc_table
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {sharding.PARTS},
    doc_id, text_crc32, size) - 1 AS slot,
  grown_shard::INTEGER AS grown_shard
FROM rows JOIN best USING (r) JOIN crc USING (r)"""


def op4_license_scan() -> str:
    notices = ", ".join(f"('{k}', '{v}')" for k, v in licenses.NOTICES.items())
    n = licenses.SHINGLE
    words = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')"
    cut = f"unnest(list_transform(range(greatest(len(w) - {n - 1}, least(len(w), 1))), lambda i: {{'place': i, 's': array_to_string(w[i + 1 : i + {n}], ' ')}}), recursive := true)"
    return f"""
WITH notices(license_id, text) AS (VALUES {notices}),
wanted AS (SELECT DISTINCT license_id, s FROM (SELECT license_id, {cut} FROM (SELECT license_id, {words} AS w FROM notices))),
sizes AS (
  SELECT license_id, count(*) AS m, greatest(1, count(*) // 4) AS stride, count(*) + greatest(1, count(*) // 4) - 1 AS span
  FROM wanted GROUP BY license_id
), shingles AS (
  SELECT doc_id, text, {cut} FROM (SELECT DISTINCT doc_id, text, {words} AS w FROM documents)
), hits AS (
  SELECT doc_id, text, license_id, s, m, stride, unnest(range(greatest(ceil((place - span + 1) / stride), 0)::BIGINT, place // stride + 1)) AS number
  FROM shingles JOIN wanted USING (s) JOIN sizes USING (license_id)
), windows AS (
  SELECT doc_id, text, license_id, number * stride AS word, count(DISTINCT s) / m AS share
  FROM hits GROUP BY doc_id, text, license_id, number, stride, m
)
SELECT doc_id, license_id, max(share) AS containment, count(*) AS n_windows, min(word)::BIGINT AS first_word
FROM windows WHERE share >= {licenses.LEAST} GROUP BY doc_id, text, license_id"""


def op10_line_templates() -> str:
    least, blank = lines.LEAST_DOCUMENTS, lines.VARIABLE
    return f"""
WITH split_lines AS (
  SELECT DISTINCT doc_id, text, unnest(range(len(string_split(text, chr(10))))) AS line, unnest(string_split(text, chr(10))) AS value FROM documents
), parsed AS (
  SELECT doc_id, text, line, list_transform(regexp_extract_all(value, '[^\\x09-\\x0D\\x20]+'),
    lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '{blank}' ELSE t END) AS tokens
  FROM split_lines
), leaves AS (
  SELECT len(tokens) AS n, tokens[1:{lines.LEADING}] AS lead FROM parsed WHERE len(tokens) > 0
  GROUP BY ALL HAVING count(DISTINCT (doc_id, text)) >= {least}
), shared AS (
  SELECT doc_id, text, line, tokens, n, lead FROM parsed JOIN leaves ON n = len(tokens) AND lead = tokens[1:{lines.LEADING}]
), different AS (
  SELECT n, lead, tokens, count(DISTINCT (doc_id, text)) AS docs FROM shared GROUP BY ALL
), spread AS (
  SELECT n, lead, tokens, docs, unnest(range(len(tokens))) AS place, unnest(tokens) AS token FROM different
), common AS (
  SELECT n, lead, place, token FROM spread GROUP BY ALL HAVING sum(docs) >= {least}
), templates AS (
  SELECT n, lead, tokens, list(CASE WHEN c.token IS NULL THEN '{blank}' ELSE s.token END ORDER BY place) AS template
  FROM spread s LEFT JOIN common c USING (n, lead, place, token) GROUP BY ALL
  HAVING count(CASE WHEN c.token IS NOT NULL AND c.token <> '{blank}' THEN 1 END) >= {lines.LEAST_FIXED}
), often AS (
  SELECT n, lead, template FROM shared JOIN templates USING (n, lead, tokens) GROUP BY ALL HAVING count(DISTINCT (doc_id, text)) >= {least}
), gone AS (
  SELECT DISTINCT doc_id, text, line FROM shared JOIN templates USING (n, lead, tokens) JOIN often USING (n, lead, template)
), kept AS (
  SELECT doc_id, text, count(*) FILTER (gone.line IS NOT NULL) AS n_dropped,
    coalesce(string_agg(CASE WHEN gone.line IS NULL THEN value END, chr(10) ORDER BY split_lines.line), '') AS rest
  FROM split_lines LEFT JOIN gone USING (doc_id, text, line) GROUP BY doc_id, text
)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, rest AS text
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id AND d.text = k.text"""


def op12_fill_in_middle() -> str:
    p, s, m = fill_in_middle.PREFIX, fill_in_middle.SUFFIX, fill_in_middle.MIDDLE
    draw = [f"('0x' || h[{8 * i + 1}:{8 * i + 8}])::BIGINT" for i in range(4)]
    return f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('{fill_in_middle.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), cut AS (
  SELECT *, least({draw[0]} % (len(u) + 1), {draw[1]} % (len(u) + 1)) AS a, greatest({draw[0]} % (len(u) + 1), {draw[1]} % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '{p}') OR contains(t, '{s}') OR contains(t, '{m}') OR {draw[2]} % 100 >= {100 - fill_in_middle.PLAIN} THEN 'plain'
      WHEN {draw[3]} % 100 < {fill_in_middle.SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
  FROM texts
), parts AS (
  SELECT *, array_to_string(u[1:a], '') AS before, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS after FROM cut
)
SELECT doc_id, len(u) AS n, form, CASE WHEN form <> 'plain' THEN length(before) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{p}' || before || '{s}' || after || '{m}' || middle
    ELSE '{s}' || after || '{p}' || before || '{m}' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""


def op13_vector_file_clusters() -> str:
    n, k = vector_file.N_COMPONENTS, vector_file.K
    distance = "list_sum(list_transform(list_zip(f.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    steps = [f"""
kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({vector_file.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {n} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {n}
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('{vector_file.SEED}:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS k, v FROM kept QUALIFY k < {k}
)"""]
    for i in range(vector_file.ROUNDS + 1):
        steps.append(f"a{i} AS (SELECT r, min({{'d': {distance}, 'k': k}}) AS best FROM kept f, c{i} c GROUP BY r)")
        if i < vector_file.ROUNDS:
            steps.append(f"""means{i} AS (
  SELECT k, list(((s - ((s % n + n) % n)) // n)::BIGINT ORDER BY place) AS v FROM (
    SELECT best.k AS k, place, sum(x)::BIGINT AS s, count(*) AS n
    FROM (SELECT best, unnest(v) AS x, unnest(range({n})) AS place FROM a{i} JOIN kept USING (r)) GROUP BY best.k, place
  ) GROUP BY k
), c{i + 1} AS (SELECT c.k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN means{i} m USING (k))""")
    last = vector_file.ROUNDS
    return f"""
WITH {", ".join(steps)}
SELECT vec_id, best.k::INTEGER AS cluster, best.d AS distance, sum(best.d) OVER (PARTITION BY best.k)::BIGINT AS cluster_inertia,
  sum(best.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{last} JOIN kept USING (r) JOIN c{last} c ON c.k = best.k"""


def statements() -> dict[str, str]:
    return {f.__name__: f() for f in (op3_rendezvous_shards, op4_license_scan, op10_line_templates, op12_fill_in_middle, op13_vector_file_clusters)}
