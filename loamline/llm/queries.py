"""The registered queries of this subpackage over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm import best_position, exact_dedup, html_text, language_id, merkle, near_dedup, packing, pii, quality, repeats, token_files, topk, unigram
from loamline.llm.tables import crc_bucket, table
from loamline.staging import new_path, stage

# A demonstration key; a deployment passes its own secret.
DEMO_KEY = b"loamline-demonstration-key-00000"


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary files lie on this machine and its workers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op2_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_personal_data(table(spark, sf_dir, "documents"), DEMO_KEY)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    texts = html_text.extract(pages, keep=("url",))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    index = stage(token_files.write_token_files(docs, folder, tokenizer_path("word_bpe_49k.json")), "token-index")
    read = token_files.read_token_files(token_files.with_starts(spark, index), folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit(docs))
    return found.select("doc_id", (crc_bucket("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op7_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = unigram.load_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents")
    coded = unigram.encode_documents(docs, vocabulary)
    return coded.select("doc_id", "n_pieces", F.crc32("ids").alias("ids_crc32"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_classes(table(spark, sf_dir, "documents"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = stage(quality.described(docs), "quality-statistics")
    scored = quality.scored(rows, quality.learn(rows, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_bucket("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_documents(
        table(spark, sf_dir, "documents"),
        tampered=crc_bucket("doc_id", 2) == 0,
        changed=F.replace("text", F.lit("\n"), F.lit("")),
        columns=["doc_id", "source", "lang", "n_chars", "text"],
        key="doc_id",
        tree="source",
        text="text",
    )


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_position.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_pii_pseudonyms": op2_pii_pseudonyms,
    "op3_packing": op3_packing,
    "op4_html_text": op4_html_text,
    "op5_token_files": op5_token_files,
    "op6_language_id": op6_language_id,
    "op7_unigram": op7_unigram,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_topk": op9_topk,
    "op10_quality": op10_quality,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_ranked_search": op12_ranked_search,
    "op13_repeated_passages": op13_repeated_passages,
}

SQL = {
    "op1_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 1 THEN [words[1]]
                       ELSE [words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))] END) AS shingle
            FROM w WHERE len(words) > 0),
        n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
        k AS (SELECT shingle, doc_id, dense_rank() OVER (ORDER BY shingle) AS id FROM s),
        p AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
            FROM k a JOIN k b ON a.id = b.id AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
        l AS (
            SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
            WHERE 100 * common >= 80 * (nx.size + ny.size - common)),
        e AS (SELECT x AS u, y AS v FROM l UNION SELECT y, x FROM l),
        r(doc_id, reached) AS (
            SELECT doc_id, doc_id FROM w
            UNION
            SELECT r.doc_id, e.v FROM r JOIN e ON e.u = r.reached)
        SELECT r.doc_id, coalesce(max(n.size), 0) AS n_shingles, min(reached) AS component_id,
               min(reached) = r.doc_id AS kept
        FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
    """,
    "op9_topk": """
        WITH v AS (
            SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        p AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)]) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM p)
        SELECT query_id, place AS rank, vec_id, score FROM r WHERE place <= 10
    """,
    "op8_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents),
        r AS (
            SELECT doc_id, norm,
                   row_number() OVER w AS place,
                   count(*) OVER (PARTITION BY norm) AS group_size,
                   first_value(doc_id) OVER w AS keep_id
            FROM n WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id NULLS LAST))
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM r
    """,
    "op11_merkle_manifest": r"""
        WITH RECURSIVE base AS (
            SELECT row_number() OVER () AS rid, doc_id, coalesce('s' || source, '') AS tree,
                   sha256(concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                       coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'),
                       coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
                   coalesce(list_reduce([4294967295::UBIGINT] || [ascii(c)::UBIGINT FOR c IN string_split(doc_id::VARCHAR, '')],
                       lambda crc, byte: list_reduce([xor(crc, byte)] || range(8)::UBIGINT[],
                           lambda r, bit: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384::UBIGINT) ELSE r // 2 END)), 0) % 2 = 1 AS even,
                   sha256(concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                       coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'),
                       coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))) AS other
            FROM documents),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                   count(*) OVER (PARTITION BY tree) AS n, CASE WHEN even THEN other ELSE leaf END AS claim FROM base),
        nodes(tree, lvl, pos, n, h) AS (
            SELECT tree, 0, pos, n, leaf FROM ranked
            UNION ALL
            SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes
            WHERE n > 1 GROUP BY tree, lvl, pos // 3, n),
        subroots AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
        tops(lvl, pos, n, h) AS (
            SELECT 0, pos, n, subroot FROM subroots
            UNION ALL
            SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM tops
            WHERE n > 1 GROUP BY lvl, pos // 3, n),
        runs AS (SELECT tree, lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM nodes WHERE n > 1 GROUP BY ALL),
        top_runs AS (SELECT lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM tops WHERE n > 1 GROUP BY ALL),
        low(rid, tree, lvl, pos, n, cur, proof) AS (
            SELECT rid, tree, 0, pos, n, claim, '' FROM ranked
            UNION ALL
            SELECT rid, l.tree, l.lvl + 1, pos // 3, (n + 2) // 3,
                   sha256(concat(array_to_string(hs[1:pos % 3], ''), cur, array_to_string(hs[pos % 3 + 2:], ''))),
                   concat(proof, array_to_string(hs[1:pos % 3], ''), array_to_string(hs[pos % 3 + 2:], ''))
            FROM low l JOIN runs r ON r.tree = l.tree AND r.lvl = l.lvl AND r.run = pos // 3 WHERE n > 1),
        high(rid, lvl, pos, n, cur, proof) AS (
            SELECT rid, 0, s.pos, s.n, cur, proof FROM low l JOIN subroots s ON s.tree = l.tree WHERE l.n = 1
            UNION ALL
            SELECT rid, l.lvl + 1, pos // 3, (n + 2) // 3,
                   sha256(concat(array_to_string(hs[1:pos % 3], ''), cur, array_to_string(hs[pos % 3 + 2:], ''))),
                   concat(proof, array_to_string(hs[1:pos % 3], ''), array_to_string(hs[pos % 3 + 2:], ''))
            FROM high l JOIN top_runs r ON r.lvl = l.lvl AND r.run = pos // 3 WHERE n > 1),
        top AS (SELECT h AS root FROM tops WHERE n = 1)
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
        FROM ranked JOIN high USING (rid) JOIN subroots s ON s.tree = ranked.tree, top WHERE high.n = 1
    """,
    "op12_ranked_search": r"""
        WITH t AS (
            SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        g AS (SELECT count(*) AS all_docs, sum(len(terms))::BIGINT AS all_terms FROM t WHERE len(terms) > 0),
        o AS (SELECT rid, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
              FROM (SELECT rid, doc_id, len(terms) AS n, unnest(terms) AS term FROM t) GROUP BY rid, term),
        q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        w AS (SELECT term, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
              FROM o, g GROUP BY term, all_docs),
        s AS (
            SELECT item_id, rid, any_value(doc_id) AS doc_id,
                   sum(w.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_docs) // all_terms))))::BIGINT AS score
            FROM q JOIN o USING (term) JOIN w USING (term), g GROUP BY item_id, rid),
        r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, rid) AS rank
              FROM s WHERE score > 0)
        SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 10
    """,
    "op13_repeated_passages": r"""
        WITH b AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS ord,
                          hex(encode(coalesce(text, ''))) AS hx FROM documents),
        c AS (SELECT rid, ord, o, substr(hx, 2 * o + 1, 2 * (512 + 49)) AS part
              FROM (SELECT rid, ord, hx, unnest(range(0, len(hx) // 2, 512)) AS o FROM b)),
        g AS (SELECT rid, ord, o + i AS p, substr(part, 2 * i + 1, 100) AS gram
              FROM (SELECT rid, ord, o, part, unnest(range(0, least(512, len(part) // 2 - 49))) AS i FROM c)),
        m AS (SELECT gram, min(ord) AS least FROM g GROUP BY gram),
        d AS (SELECT rid, p FROM g JOIN m USING (gram) WHERE least < ord),
        j AS (SELECT rid, p, p - lag(p) OVER (PARTITION BY rid ORDER BY p) <= 50 AS joined FROM d),
        i AS (SELECT rid, p, count(*) FILTER (joined IS DISTINCT FROM TRUE) OVER (PARTITION BY rid ORDER BY p) AS island FROM j),
        s AS (SELECT rid, min(p) AS a, max(p) + 50 AS z FROM i GROUP BY rid, island),
        o AS (SELECT rid, a, z, coalesce(lag(z) OVER (PARTITION BY rid ORDER BY a), 0) AS prev FROM s),
        k AS (SELECT rid, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, max(z) AS tail,
                     string_agg(substr(hx, 2 * prev + 1, 2 * (a - prev)), '' ORDER BY a) AS kept
              FROM o JOIN b USING (rid) GROUP BY rid)
        SELECT doc_id, len(hx) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(CASE WHEN k.rid IS NULL THEN hx ELSE kept || substr(hx, 2 * tail + 1) END)) AS kept_sha256
        FROM b LEFT JOIN k USING (rid)
    """,
}
