"""The operators applied to whole tables, by query name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalstar.llm import (
    chosen_path,
    collocations,
    content_sort,
    lattice,
    licenses,
    limb_codes,
    mixing,
    ordinal,
    packing,
    paragraph_sketch,
    pii,
    url_trees,
    wrappers,
)
from signalstar.llm.common import read

MIX_WEIGHTS = {
    "domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
    "source": {},
}
MIX_PERCENT, MIX_EPOCHS, MIX_SEED = 90, 3, 17


def mix_levels() -> dict[str, Column]:
    """Domain, language, source; the source's number in four groups stands for a domain."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]+)$", 1)
    group = F.when(number == "", "0").otherwise((number.cast("bigint") % 4).cast("string"))
    return {"domain": F.concat(F.lit("d"), group), "lang": F.col("lang"), "source": F.col("source")}


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return mixing.mixed(docs, mix_levels(), MIX_WEIGHTS, MIX_PERCENT, MIX_EPOCHS, MIX_SEED)


def op2_content_sort(spark: SparkSession, folder: str) -> DataFrame:
    return content_sort.duplicate_groups(read(spark, folder, "documents"))


def op3_disclosure(spark: SparkSession, folder: str) -> DataFrame:
    rows = pii.personal_data(read(spark, folder, "documents"))
    return rows.withColumn("clean_sha256", F.sha2(F.col("clean_text").cast("binary"), 256)).drop("clean_text")


def op4_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.main_text(read(spark, folder, "pages"))


def op5_vector_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read(spark, folder, "documents"))


def op6_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    return ordinal.quality_grades(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op7_compression(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_notices(read(spark, folder, "documents"))


def op8_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    return chosen_path.near_duplicates(read(spark, folder, "documents"))


def op9_url_trees(spark: SparkSession, folder: str) -> DataFrame:
    return url_trees.url_verdicts(read(spark, folder, "pages"))


def op10_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_vectors(read(spark, folder, "embeddings"))


def op11_limb_gemm(spark: SparkSession, folder: str) -> DataFrame:
    return limb_codes.vector_codes(read(spark, folder, "embeddings"))


def op12_paragraph_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return paragraph_sketch.paragraph_fingerprints(read(spark, folder, "documents"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(read(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_content_sort": op2_content_sort,
    "op3_disclosure": op3_disclosure,
    "op4_wrappers": op4_wrappers,
    "op5_vector_packing": op5_vector_packing,
    "op6_ordinal_quality": op6_ordinal_quality,
    "op7_compression": op7_compression,
    "op8_chosen_path": op8_chosen_path,
    "op10_lattice": op10_lattice,
    "op9_url_trees": op9_url_trees,
    "op11_limb_gemm": op11_limb_gemm,
    "op12_paragraph_sketch": op12_paragraph_sketch,
    "op13_collocations": op13_collocations,
}

def _mixing_sql() -> str:
    """Budgets by comparing each child with its siblings, then running token sums."""
    levels = ["domain", "lang", "source"]
    parts, above = [], "SELECT sum(tokens) * {} // 100 AS budget FROM counted".format(MIX_PERCENT)
    for depth, level in enumerate(levels):
        path = levels[: depth + 1]
        keys, parent = ", ".join(path), path[:-1]
        join = f"JOIN ({above}) p USING ({', '.join(parent)})" if parent else f"CROSS JOIN ({above}) p"
        family = " AND ".join(["true", *[f"s.{c} = c.{c}" for c in parent]])
        first = f"(s.cap / s.weight, s.{level}) < (c.cap / c.weight, c.{level})"
        weight = " ".join(f"WHEN '{k}' THEN {v}" for k, v in MIX_WEIGHTS[level].items())
        weight = f"CASE {level} {weight} ELSE 1 END" if weight else "1"
        parts.append(f"""
        child_{level} AS (
            SELECT {keys}, CAST({MIX_EPOCHS} * sum(tokens) AS BIGINT) AS cap, any_value(budget) AS budget,
                   {weight} AS weight
            FROM counted {join} GROUP BY {keys}),
        placed_{level} AS (
            SELECT *, greatest(budget - coalesce(used, 0), 0) AS rest FROM (
                SELECT c.*, sum(s.cap) FILTER (WHERE {first}) AS used,
                       sum(s.weight) FILTER (WHERE NOT ({first})) AS open
                FROM child_{level} c JOIN child_{level} s ON {family} GROUP BY ALL)),
        level_{level} AS (
            SELECT {", ".join([*parent, "true AS some"])},
                   arg_min(rest, (cap / weight, {level})) AS rest, arg_min(open, (cap / weight, {level})) AS open,
                   min((cap / weight, {level})) AS since
            FROM placed_{level} WHERE cap * open > rest * weight GROUP BY ALL),
        budget_{level} AS (
            SELECT {", ".join("c." + c for c in path)},
                   CASE WHEN s.since IS NULL OR (c.cap / c.weight, c.{level}) < s.since THEN c.cap
                        ELSE least(s.rest * c.weight // s.open, c.cap) END AS budget
            FROM placed_{level} c LEFT JOIN level_{level} s ON {family})""")
        above = f"SELECT * FROM budget_{level}"
    return r"""
        WITH counted AS (
            SELECT doc_id, 'd' || CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4 AS domain,
                   lang, source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS tokens
            FROM documents WHERE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) > 0),
    """ + ",".join(parts) + f""",
        leaves AS (
            SELECT domain, lang, source, CAST(budget AS BIGINT) AS leaf_budget,
                   budget // leaf_tokens AS whole, budget % leaf_tokens AS part
            FROM budget_source
            JOIN (SELECT domain, lang, source, sum(tokens) AS leaf_tokens FROM counted GROUP BY ALL)
              USING (domain, lang, source)),
        ordered AS (
            SELECT counted.*, leaf_budget, whole,
                   part - coalesce(sum(tokens) OVER (
                       PARTITION BY domain, lang, source
                       ORDER BY md5('{MIX_SEED}:' || (whole + 1) || ':' || doc_id), tokens
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
            FROM counted JOIN leaves USING (domain, lang, source)),
        taken AS (
            SELECT *, unnest(generate_series(1, CAST(whole AS BIGINT))) AS epoch, tokens AS take FROM ordered
            UNION ALL SELECT *, whole + 1, least(tokens, room) FROM ordered WHERE room > 0)
        SELECT doc_id, domain, lang, source, CAST(epoch AS BIGINT) AS epoch, tokens,
               CAST(take AS BIGINT) AS take_tokens, leaf_budget
        FROM taken
    """


# The patterns as they are defined, for the comparison.
PLAIN_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _disclosure_sql() -> str:
    def found(kind: str, no: int, pattern: str, rows: str) -> str:
        """Matches with their places, from the lengths of all pieces before them."""
        return f"""
            SELECT doc_id, '{kind}' AS kind, {no} AS no, text, m[i] AS value,
                   CAST(list_sum(list_transform(g[1 : i], lambda x: length(x)))
                        + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: length(x))), 0)
                        AS BIGINT) AS "from"
            FROM (SELECT doc_id, text, m, g, unnest(range(1, len(m) + 1)) AS i FROM (
                SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS m,
                       regexp_split_to_array(text, '{pattern}') AS g FROM {rows}))"""

    every = " UNION ALL ".join(
        found(kind, no, pattern, "docs") for no, (kind, pattern) in enumerate(PLAIN_PATTERNS.items())
    )
    number = "+ 9 * CAST(d[-k] > '4' AS INTEGER) * -1"
    luhn = f"""list_sum(list_transform(range(1, len(d) + 1), lambda k:
        CASE WHEN k % 2 = 1 THEN CAST(d[-k] AS INTEGER) ELSE 2 * CAST(d[-k] AS INTEGER) {number} END))"""
    return rf"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        every AS (SELECT *, regexp_replace(value, '[^0-9]', '', 'g') AS d FROM ({every})),
        base AS (
            SELECT *, "from" + length(value) AS upto FROM every
            WHERE CASE kind
                WHEN 'ip' THEN list_bool_and(list_transform(
                    string_split(value, '.'), lambda x: length(ltrim(x, '0')) <= 3
                    AND coalesce(TRY_CAST(x AS INTEGER), 256) <= 255))
                WHEN 'card' THEN length(d) BETWEEN 12 AND 19 AND {luhn} % 10 = 0
                WHEN 'phone' THEN length(d) BETWEEN 9 AND 15
                ELSE true END),
        entities AS (
            SELECT DISTINCT doc_id,
                   kind || ':' || CASE WHEN kind IN ('card', 'phone') THEN d ELSE lower(value) END AS entity
            FROM base),
        doc_words AS (
            SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS term FROM docs),
        n_term AS (SELECT term, count(*) AS n_t FROM doc_words GROUP BY term),
        n_entity AS (SELECT entity, count(*) AS n_e FROM entities GROUP BY entity),
        near AS (
            SELECT doc_id, entity, term
            FROM entities JOIN n_entity USING (entity) JOIN doc_words USING (doc_id)
            WHERE n_e >= {pii.SUPPORT}),
        flagged AS (
            SELECT entity, term
            FROM (SELECT entity, term, count(*) AS n_et FROM near GROUP BY ALL) pairs
            JOIN n_entity USING (entity) JOIN n_term USING (term)
            CROSS JOIN (SELECT count(*) AS n FROM docs) total
            WHERE n_et >= {pii.SUPPORT} AND n_e < n
              AND ln(n * n_et / (n_e * n_t)) >= {pii.DISCLOSURE} * ln(n / n_e)),
        wanted AS (SELECT DISTINCT doc_id, term FROM near JOIN flagged USING (entity, term)),
        words AS ({found("term", 4, r"\p{L}+", "(SELECT * FROM docs WHERE doc_id IN (SELECT doc_id FROM wanted)) x")}),
        added AS (
            SELECT w.doc_id, w.kind, w.no, w."from", w."from" + length(w.value) AS upto
            FROM words w JOIN wanted ON w.doc_id = wanted.doc_id AND lower(w.value) = wanted.term
            WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = w.doc_id
                              AND b."from" < w."from" + length(w.value) AND w."from" < b.upto)),
        spans AS (
            SELECT *, kind || ':' || "from" || ':' || upto AS span,
                   coalesce(max(upto) OVER (PARTITION BY doc_id ORDER BY "from", no
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done
            FROM (SELECT doc_id, kind, no, "from", upto FROM base UNION ALL SELECT * FROM added)),
        cleaned AS (
            SELECT doc_id, sha256(
                string_agg(substr(text, done + 1, "from" - done)
                           || CASE kind WHEN 'term' THEN '[...]' ELSE '[' || kind || ']' END,
                           '' ORDER BY "from", no) FILTER (WHERE "from" >= done)
                || substr(any_value(text), max(upto) + 1)) AS clean_sha256
            FROM spans JOIN docs USING (doc_id) GROUP BY doc_id)
        SELECT doc_id,
               {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in PLAIN_PATTERNS)},
               sha256(coalesce(string_agg(span, ',' ORDER BY "from", no) FILTER (WHERE no < 4), '')) AS base_sha256,
               coalesce(string_agg(span, ',' ORDER BY "from", no), '') AS spans,
               count(*) FILTER (WHERE kind = 'term') AS n_term,
               any_value(clean_sha256) AS clean_sha256
        FROM docs LEFT JOIN spans USING (doc_id) LEFT JOIN cleaned USING (doc_id) GROUP BY doc_id
    """


def _limb_sql() -> str:
    """The rounds one after the other, with distances summed component by component."""
    far = "list_sum(list_transform(range(1, len(a.x) + 1), lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i])))"
    parts, rounds = limb_codes.PARTS, limb_codes.ROUNDS
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
        near_{k} AS MATERIALIZED (
            SELECT row, part, any_value(x) AS x, min(far) AS far, arg_min(entry, (far, entry)) AS entry
            FROM (SELECT a.row, a.part, a.x, b.entry, {far} AS far FROM parts a JOIN book_{k} b USING (part))
            GROUP BY row, part)""")
        if k < rounds:
            steps.append(f"""
        book_{k + 1} AS MATERIALIZED (
            SELECT part, entry, coalesce(m.x, b.x) AS x FROM book_{k} b LEFT JOIN (
                SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x
                FROM (SELECT part, entry, i, sum(v) AS s, count(*) AS n
                      FROM (SELECT part, entry, unnest(x) AS v, unnest(range(len(x))) AS i FROM near_{k})
                      GROUP BY ALL)
                GROUP BY part, entry) m USING (part, entry))""")
    return f"""
        WITH kept AS (
            SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) AS row,
                   list_transform(embedding, lambda x: CAST(floor({limb_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS MATERIALIZED (
            SELECT row, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] AS x
            FROM kept, range({parts}) t(part)),
        book_0 AS (SELECT part, row - 1 AS entry, x FROM parts WHERE row <= {limb_codes.ENTRIES}),
        {",".join(steps)},
        coded AS (
            SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
                   CAST(sum(far) AS BIGINT) AS error
            FROM near_{rounds} GROUP BY row)
        SELECT vec_id, code, error,
               CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM book_{rounds})
                   AS codebooks_sha256
        FROM kept JOIN coded USING (row)
    """


def _sketch_sql() -> str:
    """The cells by grouping; the likeness from the paragraphs that two documents share."""
    return rf"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        versions AS (
            SELECT doc_id, length(text) AS n_chars, text, 'own' AS version FROM docs
            UNION ALL
            SELECT doc_id, length(text),
                   substr(text, 1, length(text) - length(text) // 2) || substr(next, 1, length(text) // 2), 'edited'
            FROM (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC),
                                     first_value(text) OVER (ORDER BY doc_id DESC)) AS next FROM docs)),
        parts AS (
            SELECT DISTINCT doc_id, version, CAST('0x' || substr(md5(p), 1, 15) AS BIGINT) AS x
            FROM (SELECT doc_id, version, unnest(regexp_split_to_array(text, '[\n\x0B\f\r]+')) AS p FROM versions)
            WHERE p <> ''),
        hashed AS (
            SELECT *, xor((x & 2147483647) * {paragraph_sketch.LOW}, (x >> 31) * {paragraph_sketch.HIGH}) AS y FROM parts),
        cells AS (
            SELECT doc_id, version, cell, count(*) AS n, bit_xor(x) AS xs, bit_xor(y) AS ys
            FROM (SELECT *, unnest([(y >> 24) & 7, ((y >> 29) & 7) + 8, ((y >> 34) & 7) + 16]) AS cell FROM hashed)
            GROUP BY ALL),
        prints AS (
            SELECT v.doc_id, v.version, v.n_chars, v.text,
                   string_agg(printf('%d:%x:%x', coalesce(n, 0), coalesce(xs, 0), coalesce(ys, 0)), ',' ORDER BY c) AS print
            FROM versions v, range(24) t(c)
            LEFT JOIN cells ON cells.doc_id = v.doc_id AND cells.version = v.version AND cells.cell = c
            GROUP BY ALL),
        sizes AS (SELECT doc_id, version, count(*) AS n FROM parts GROUP BY ALL),
        pairs AS (
            SELECT doc_id, doc_id AS other, 'edited' AS kind FROM docs
            UNION ALL
            SELECT doc_id, coalesce(lead(doc_id) OVER (ORDER BY doc_id DESC),
                                    first_value(doc_id) OVER (ORDER BY doc_id DESC)), 'own' FROM docs),
        shared AS (
            SELECT q.doc_id, q.kind, count(*) AS n
            FROM pairs q JOIN parts a ON a.doc_id = q.doc_id AND a.version = 'own'
            JOIN parts b ON b.doc_id = q.other AND b.version = q.kind AND b.x = a.x
            GROUP BY ALL),
        likeness AS (
            SELECT q.doc_id, q.kind,
                   CASE WHEN coalesce(a.n, 0) + coalesce(b.n, 0) = 0 THEN 1.0::DOUBLE
                        ELSE (2 * coalesce(s.n, 0))::DOUBLE
                             / (2 * (coalesce(a.n, 0) + coalesce(b.n, 0) - coalesce(s.n, 0)))::DOUBLE END AS near
            FROM pairs q LEFT JOIN sizes a ON a.doc_id = q.doc_id AND a.version = 'own'
            LEFT JOIN sizes b ON b.doc_id = q.other AND b.version = q.kind
            LEFT JOIN shared s ON s.doc_id = q.doc_id AND s.kind = q.kind)
        SELECT o.doc_id, o.n_chars, sha256(e.text) AS edited_sha256, o.print AS fingerprint, e.print AS edited_fingerprint,
               x.near AS near_edited, y.near AS near_next
        FROM prints o JOIN prints e ON e.doc_id = o.doc_id AND e.version = 'edited'
        JOIN likeness x ON x.doc_id = o.doc_id AND x.kind = 'edited'
        JOIN likeness y ON y.doc_id = o.doc_id AND y.kind = 'own'
        WHERE o.version = 'own'
    """


SQL: dict[str, str] = {
    "op11_limb_gemm": _limb_sql(),
    "op12_paragraph_sketch": _sketch_sql(),
    "op13_collocations": r"""
        WITH docs AS (
            SELECT coalesce(lang, 'und') AS lang,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents),
        pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
        listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        grams AS (
            SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase, count(*) AS f
            FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM listed, range(1, 4) s(size))
            GROUP BY ALL),
        totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE size = 1 GROUP BY lang),
        candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE size > 1 AND f >= 10),
        cuts AS (
            SELECT c.lang, c.size, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
                   CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
            FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
            JOIN grams x ON x.lang = c.lang AND x.size = c.k AND x.phrase = array_to_string(c.w[1 : c.k], ' ')
            JOIN grams y ON y.lang = c.lang AND y.size = c.size - c.k AND y.phrase = array_to_string(c.w[c.k + 1 :], ' ')),
        scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inside AS (
            SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a AS longer
            FROM candidates WHERE size = 3),
        covered AS (SELECT lang, phrase, max(longer) AS longer FROM inside GROUP BY ALL),
        ranked AS (
            SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
            FROM scored s LEFT JOIN covered c ON c.lang = s.lang AND c.phrase = s.phrase AND s.size = 2
            WHERE c.longer IS NULL OR 100 * c.longer < 50 * s.a)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
    "op3_disclosure": _disclosure_sql(),
    "op1_mixing": _mixing_sql(),
    "op2_content_sort": r"""
        WITH normal AS (
            SELECT doc_id, coalesce(text, '') AS body,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
            FROM documents
        )
        SELECT doc_id,
               first_value(doc_id) OVER best AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER best = 1 AS kept,
               sha256(norm) AS text_sha256
        FROM normal
        WINDOW best AS (PARTITION BY norm ORDER BY length(body) DESC, doc_id)
    """,
    "op8_chosen_path": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\s+'),
                                       lambda x: x <> '') AS w
            FROM documents
        ),
        shingles AS (
            SELECT DISTINCT doc_id,
                   unnest([array_to_string(w[i : i + 4], ' ') for i in range(1, greatest(len(w) - 3, 2))])
                     AS shingle
            FROM words WHERE len(w) > 0
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS one, b.doc_id AS other, count(*) AS common
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY ALL
        ),
        links AS (
            SELECT one, other FROM shared
            JOIN sizes x ON x.doc_id = one JOIN sizes y ON y.doc_id = other
            WHERE common >= 0.8 * (x.n + y.n - common) - 1e-9
        ),
        reach AS (
            SELECT doc_id AS origin, doc_id AS node FROM documents
            UNION SELECT origin, other FROM reach JOIN links ON one = node
        ),
        classes AS (SELECT origin AS doc_id, min(node) AS class_id FROM reach GROUP BY origin)
        SELECT doc_id, class_id, (SELECT count(*) FROM links WHERE one = doc_id) AS n_links,
               doc_id = class_id AS kept
        FROM classes
    """,
    "op10_lattice": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        usable AS (
            SELECT vec_id, label, v, len(v) AS dims, sqrt(list_dot_product(v, v)) AS size
            FROM vectors WHERE list_dot_product(v, v) > 0
        ),
        links AS (
            SELECT a.vec_id AS one, b.vec_id AS other
            FROM usable a JOIN usable b
              ON a.label = b.label AND a.dims = b.dims AND a.vec_id <> b.vec_id
            WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.93
        ),
        reach AS (
            SELECT vec_id AS origin, vec_id AS node FROM embeddings
            UNION SELECT origin, other FROM reach JOIN links ON one = node
        ),
        classes AS (SELECT origin AS vec_id, min(node) AS component_id FROM reach GROUP BY origin)
        SELECT vec_id, (SELECT count(*) FROM links WHERE one = vec_id) AS n_links, component_id,
               vec_id = component_id AS kept
        FROM classes
    """,
}
