"""Policy-text retrieval, memos, quality figures, logs and drift."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from lendgrid.catalog.feature_queries import FEATURE_INPUTS, stored_features, _scratch
from lendgrid.catalog.model_queries import NAMES, _REASONS_SQL, _linear_scorer
from lendgrid.catalog.registry import register
from lendgrid.catalog.views import LETTERS, numeric_psi_sql, psi_sql
from lendgrid.functions import defaults
from lendgrid.functions.texts import snippet, tokens
from lendgrid.operators import answers as an, attributions as at, drift as dr, fusion as fu, keyword as kw
from lendgrid.operators import reasons as re_, review as rv, scoring as sc, vector_index as vi, vectors as ve
from lendgrid.operators.batches import apply_in_batches
from lendgrid.operators.chunks import chunk_documents
from lendgrid.operators.models import feature_columns
from lendgrid.operators.replies import ReplyStore
from lendgrid.plans.retrieval import hybrid_candidates, policy_citations, retrieve
from lendgrid.session import cut_lineage, spread
from lendgrid.sources import proxy, tables
from lendgrid.sources.keyed_store import KeyedStore
from lendgrid.sources.corpus import scan_corpus, split_title, write_corpus
from lendgrid.sources.score_log import append_log, log_entries, read_log, summarize_log
from lendgrid.streaming import score_log as stream
from lendgrid.streaming.log_store import LogStore, known_only, start_log_store

# corpus and chunks


def _chunks(spark, d):
    return chunk_documents(spread(proxy.policy_documents(spark, d)))


CHUNK_COLUMNS = ("doc_id", "chunk_no", "chunk_id", "title", "text")


@register(
    "io8_title_and_body",
    r"""SELECT doc_id, trim(regexp_replace(string_split(t, chr(10))[1], '^#+', '')) AS title,
          trim(substr(t, length(string_split(t, chr(10))[1]) + 1), ' ' || chr(9) || chr(10) || chr(13)) AS body
        FROM (SELECT doc_id, trim('# ' || text, ' ' || chr(9) || chr(10) || chr(13)) AS t FROM documents)""",
    (), ("doc_id", "title", "body"),
)
def io8_title_and_body(spark, d):
    title, body = split_title(F.concat(F.lit("# "), F.col("text")))
    return proxy.given(spark, d, "documents").select("doc_id", title.alias("title"), body.alias("body"))


@register(
    "io7_corpus",
    r"""SELECT 'Doc ' || doc_id AS title, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS text FROM documents""", (), ("title", "text"),
)
def io7_corpus(spark, d):
    """Every document written as a file of its own, then read back as a corpus."""
    folder = _scratch(spark, "corpus")
    page = F.concat(F.lit("# "), F.col("title"), F.lit("\n\n"), F.col("text"))
    # making a file takes far longer than moving its text
    write_corpus(spread(proxy.policy_documents(spark, d)).select(page.alias("value")), folder)
    return scan_corpus(spark, folder, "*.txt")


@register("io9_chunk_store", "SELECT doc_id, chunk_id, title, text FROM chunks", ("chunks",), ("doc_id", "chunk_id", "title", "text"))
def io9_chunk_store(spark, d):
    path = _scratch(spark, "chunks")
    tables.write_chunks(_chunks(spark, d), path)
    return tables.read_chunks(spark, path)


@register("r1_word_chunks", "SELECT doc_id, chunk_no, text FROM chunks", ("chunks",), ("doc_id", "chunk_no", "text"))
def r1_word_chunks(spark, d):
    return _chunks(spark, d)


@register("r2_chunk_documents", "SELECT * FROM chunks", ("chunks",), CHUNK_COLUMNS)
def r2_chunk_documents(spark, d):
    return _chunks(spark, d)


@register(
    "r3_tokens", "SELECT chunk_id, len(t) AS n, array_to_string(t, ' ') AS tokens FROM chunk_tokens", ("chunk_tokens",),
    ("chunk_id", "n", "tokens"),
)
def r3_tokens(spark, d):
    t = _chunks(spark, d).select("chunk_id", tokens(F.col("text")).alias("t"))
    return t.select("chunk_id", F.size("t").cast("long").alias("n"), F.array_join("t", " ").alias("tokens"))


# keyword search


def _stored_chunks(spark, d):
    path = _scratch(spark, "chunks")
    tables.write_table(_chunks(spark, d), path)
    return tables.scan_parquet(spark, path)


def _index(spark, d):
    return kw.build_index(_stored_chunks(spark, d))


@register("r4_postings", "SELECT doc_id, chunk_no, term, length, tf FROM postings", ("postings",), ("doc_id", "chunk_no", "term", "length", "tf"))
def r4_postings(spark, d):
    """The postings as the stored index holds them."""
    return kw.postings(_index(spark, d)).withColumn("length", F.col("length").cast("long"))


@register("r4_terms", "SELECT * FROM terms", ("terms",), ("term", "df"), ("idf",))
def r4_terms(spark, d):
    return _index(spark, d).terms


@register("r5_keyword_search", "SELECT * FROM keyword_ranking", ("keyword_ranking",), ("query_id", "chunk_id", "rank"), ("score",))
def r5_keyword_search(spark, d):
    return kw.search(_index(spark, d), proxy.policy_questions(spark, d), defaults.CANDIDATES)


# vectors


@register(
    "r6_vector_upsert",
    """WITH incoming AS (SELECT CASE WHEN label % 2 = 0 THEN vec_id ELSE vec_id + 1000000 END AS item_id, label + 100 AS label, embedding AS v, vec_id AS o
                         FROM embeddings UNION ALL SELECT vec_id, label + 200, list_reverse(embedding), vec_id + 5000000 FROM embeddings WHERE label = 0),
         rows AS (SELECT item_id, arg_max(label, o) AS label, arg_max(v, o) AS v FROM incoming GROUP BY item_id
                  UNION ALL SELECT vec_id, label, embedding FROM embeddings WHERE vec_id NOT IN (SELECT item_id FROM incoming))
       SELECT item_id, label, len(v) AS dimensions, v[1]::DOUBLE AS head, v[64]::DOUBLE AS tail, list_sum([x::DOUBLE FOR x IN v]) AS total FROM rows""",
    (), ("item_id", "label", "dimensions"), ("head", "tail", "total"),
)
def r6_vector_upsert(spark, d):
    """Re-embedded items replace the stored ones, new ids are added; the last write of an id wins.

    Three batches go to a keyed store; the second is sent again after the third, which changes nothing, and a compaction follows.
    """
    e = proxy.given(spark, d, "embeddings")
    row = lambda item, label, vector: e.select(item.alias("item_id"), label.alias("label"), vector.alias("vector"), F.col("vec_id").alias("o"))
    vec, label, vector = F.col("vec_id"), F.col("label"), F.col("embedding")
    again = row(F.when(label % 2 == 0, vec).otherwise(vec + 1000000), label + 100, vector)
    store = KeyedStore(spark, _scratch(spark, "keyed"), "item_id")
    store.write("stored", row(vec, label, vector), "o")
    store.write("again", again, "o")
    store.write("later", row(vec, label + 200, F.reverse(vector)).where(F.col("label") == 200), "o")
    store.write("again", again, "o")
    store.compact()
    numbers = F.transform("vector", lambda v: v.cast("double"))
    return store.read().select(
        "item_id", "label", F.size("vector").cast("long").alias("dimensions"), numbers[0].alias("head"), numbers[63].alias("tail"),
        F.aggregate(numbers, F.lit(0.0), lambda a, v: a + v).alias("total"))


_CENTROID = ", ".join(f"avg(embedding[{i + 1}]::DOUBLE)" for i in range(64))


_COSINE_SQL = f"""WITH q AS (SELECT label AS query_id, [{_CENTROID}] AS v FROM embeddings GROUP BY label),
         e AS (SELECT vec_id AS item_id, embedding::DOUBLE[] AS v FROM embeddings),
         s AS (SELECT query_id, item_id, round(list_dot_product(q.v, e.v) / sqrt(list_dot_product(q.v, q.v))
                 / sqrt(list_dot_product(e.v, e.v)), 9) AS score FROM q, e)
       SELECT query_id, item_id, score, "rank" FROM (SELECT *, CAST(row_number() OVER (
         PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS "rank" FROM s) WHERE "rank" <= 10"""


def _centre_search(spark, d):
    """The vectors, and the centre of every label as a query."""
    e = proxy.given(spark, d, "embeddings")
    centre = e.groupBy(F.col("label").alias("query_id")).agg(
        F.array(*[F.avg(F.col("embedding")[i].cast("double")) for i in range(64)]).alias("vector")
    )
    return e.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector")), centre


@register("r7_cosine_top_k", _COSINE_SQL, (), ("query_id", "item_id", "rank"), ("score",))
def r7_cosine_top_k(spark, d):
    """The ten vectors nearest to the centre of every label."""
    return ve.cosine_top_k(*_centre_search(spark, d), 10)


@register("r7_indexed_top_k", _COSINE_SQL, (), ("query_id", "item_id", "rank"), ("score",))
def r7_indexed_top_k(spark, d):
    """The same rows from the table in cells, of which a query reads those that its bounds leave open."""
    vectors, centre = _centre_search(spark, d)
    return vi.search_cells(vi.build_vector_index(vectors), centre, 10)[0]


@register(
    "r7_own_neighbours",
    """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
         s AS (SELECT q.vec_id AS query_id, e.vec_id AS item_id, round(list_dot_product(q.v, e.v) / sqrt(list_dot_product(q.v, q.v))
                 / sqrt(list_dot_product(e.v, e.v)), 9) AS score FROM e AS q, e WHERE q.vec_id % 100 = 0)
       SELECT query_id, item_id, score, "rank" FROM (SELECT *, CAST(row_number() OVER (
         PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS "rank" FROM s) WHERE "rank" <= 10""",
    (), ("query_id", "item_id", "rank"), ("score",),
)
def r7_own_neighbours(spark, d):
    """Every vector whose id is divisible by 100 against all vectors, through the table in cells."""
    vectors, _ = _centre_search(spark, d)
    asked = vectors.where(F.col("item_id") % 100 == 0).select(F.col("item_id").alias("query_id"), "vector")
    return vi.search_cells(vi.build_vector_index(vectors), asked, 10)[0]


def letter_counts(texts: list[str]) -> list[list[float]]:
    """Stand-in for an embedding model: how often each letter occurs."""
    return [[float(t.count(c)) for c in LETTERS] for t in map(str.lower, texts)]


def _retrieval_inputs(spark, d, questions=None):
    # the store is written once, as after ingestion; searches scan it
    path = _scratch(spark, "store")
    embedded = apply_in_batches(_chunks(spark, d), "text", letter_counts, "vector", "array<double>")
    tables.write_table(embedded, path)
    store = tables.scan_parquet(spark, path)
    questions = proxy.policy_questions(spark, d) if questions is None else questions
    asked = apply_in_batches(questions, "query", letter_counts, "vector", "array<double>").select("query_id", "vector")
    vectors = store.select(F.col("chunk_id").alias("item_id"), "vector")
    return questions, asked, vectors, kw.build_index(store.drop("vector"))


def _fused(spark, d):
    return hybrid_candidates(*_retrieval_inputs(spark, d))


@register("r8_rank_fusion", "SELECT * FROM fused", ("fused",), ("query_id", "item_id", "rank"), ("score",))
def r8_rank_fusion(spark, d):
    return _fused(spark, d)


@register(
    "r9_reorder",
    """WITH given AS (SELECT query_id, item_id, row_number() OVER (PARTITION BY query_id ORDER BY item_id DESC) AS g
                      FROM fused WHERE "rank" % 2 = 0)
       SELECT query_id, item_id, CAST(r AS INTEGER) AS "rank" FROM (SELECT f.query_id, f.item_id,
         row_number() OVER (PARTITION BY f.query_id ORDER BY g NULLS LAST, f."rank") AS r
         FROM fused f LEFT JOIN given USING (query_id, item_id)) WHERE r <= 4""",
    ("fused",), ("query_id", "item_id", "rank"),
)
def r9_reorder(spark, d):
    """A supplied ranking names every second candidate, and one id that is no candidate."""
    fused = cut_lineage(_fused(spark, d))
    listed = fused.where(F.col("rank") % 2 == 0).groupBy("query_id").agg(
        F.sort_array(F.collect_list("item_id"), asc=False).alias("ids")  # at most twenty candidates
    )
    reply = F.to_json(F.struct(F.concat(F.array(F.lit("no-such-id")), F.col("ids")).alias("ranked_chunk_ids")))
    fenced = F.concat(F.lit("```json\n"), reply, F.lit("\n```"))
    return fu.reorder(fused, fu.parse_ranking(listed.select("query_id", fenced.alias("reply"))))


@register(
    "r10_parse_reply",
    r"""SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
          event_type <> 'error' AS parsed FROM events""",
    (), ("event_id", "k", "parsed"),
)
def r10_parse_reply(spark, d):
    """Event properties as replies: fenced, plain, and cut off for error events."""
    events = proxy.given(spark, d, "events")
    reply = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("```json\n{\"k\": "), F.lit("\n```")))
        .when(F.col("event_type") == "view", F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```")))
        .when(F.col("event_type") == "click", F.concat(F.lit("Result: ``` "), F.col("props"), F.lit(" ``` done")))
        .otherwise(F.col("props"))
    )
    parsed = fu.parse_reply(reply, "k: long", ("k",))
    return events.select("event_id", parsed.alias("v")).select("event_id", F.col("v.k").alias("k"), F.col("v").isNotNull().alias("parsed"))


@register(
    "r11_retrieve", "SELECT * FROM retrieved", ("retrieved",), ("query_id", "rank", "doc_id", "chunk_id", "title", "text")
)
def r11_retrieve(spark, d):
    return retrieve(*_retrieval_inputs(spark, d))


@register(
    "r11_retrieve_reordered",
    """WITH given AS (SELECT query_id, item_id, row_number() OVER (PARTITION BY query_id ORDER BY item_id DESC) AS g FROM fused WHERE "rank" % 2 = 0)
       SELECT query_id, CAST(r AS INTEGER) AS "rank", doc_id, chunk_id, title, text FROM (
         SELECT f.query_id, f.item_id, row_number() OVER (PARTITION BY f.query_id ORDER BY g NULLS LAST, f."rank") AS r
         FROM fused f LEFT JOIN given USING (query_id, item_id)) JOIN chunks ON item_id = chunk_id WHERE r <= 4""",
    ("fused", "chunks"), ("query_id", "rank", "doc_id", "chunk_id", "title", "text"),
)
def r11_retrieve_reordered(spark, d):
    """Retrieval with the reply of a ranking model: every second candidate, the last ids first."""
    last_first = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("item_id"))).alias("given_rank")
    return retrieve(*_retrieval_inputs(spark, d), given=lambda fused: fused.where(F.col("rank") % 2 == 0).select("query_id", "item_id", last_first))


@register(
    "r12_citations", "SELECT * FROM citations", ("citations",), ("query_id", "rank", "title", "chunk_id", "snippet")
)
def r12_citations(spark, d):
    found = retrieve(*_retrieval_inputs(spark, d))
    return found.select("query_id", "rank", "title", "chunk_id", snippet(F.col("text")).alias("snippet"))


_CONTEXT_SQL = """SELECT query_id, string_agg('[' || title || '] (id=' || chunk_id || ')' || chr(10) || text, chr(10) || chr(10)
    ORDER BY "rank") AS context FROM retrieved GROUP BY query_id"""


@register("r13_context", _CONTEXT_SQL, ("retrieved",), ("query_id", "context"))
def r13_context(spark, d):
    return an.ground(retrieve(*_retrieval_inputs(spark, d))).select("query_id", "context")


@register(
    "r14_batch_apply", "SELECT query_id, array_to_string([CAST(x AS INTEGER) FOR x IN v], ',') AS counts FROM question_vectors",
    ("question_vectors",), ("query_id", "counts"),
)
def r14_batch_apply(spark, d):
    asked = apply_in_batches(proxy.policy_questions(spark, d), "query", letter_counts, "vector", "array<double>", batch=16)
    return asked.select("query_id", F.array_join(F.transform("vector", lambda x: x.cast("int").cast("string")), ",").alias("counts"))


@register(
    "r14_reply_store",
    """SELECT query_id, array_to_string([CAST(x AS INTEGER) FOR x IN v], ',') AS counts, (SELECT count(DISTINCT query) FROM questions) AS n_replies
       FROM question_vectors UNION ALL SELECT query_id + 1000000, array_to_string([CAST(x AS INTEGER) FOR x IN v], ','),
         (SELECT count(DISTINCT query) FROM questions) FROM question_vectors""",
    ("questions", "question_vectors"), ("query_id", "counts", "n_replies"),
)
def r14_reply_store(spark, d):
    """Each question twice, asked in a first run about even ids and in a second one about all: a reply per text is kept."""
    questions = proxy.policy_questions(spark, d)
    twice = questions.unionByName(questions.withColumn("query_id", F.col("query_id") + 1_000_000))
    table = KeyedStore(spark, _scratch(spark, "replies"), "digest")
    store = ReplyStore(table, "letters", "array<double>")
    store.ask(twice.where(F.col("query_id") % 2 == 0), "query", letter_counts, "vector")
    asked = store.ask(twice, "query", letter_counts, "vector")
    counts = F.array_join(F.transform("vector", lambda x: x.cast("int").cast("string")), ",")
    return asked.select("query_id", counts.alias("counts"), F.lit(table.read().count()).alias("n_replies"))


def measure_prompt(prompts: list[str]) -> list[str]:
    """Stand-in for a chat model: the size of what it was asked."""
    return [f"{len(p)} caracteres" for p in prompts]


@register(
    "r15_answers",
    f"""SELECT query_id, (length('Contexto:' || chr(10) || chr(10) || context || chr(10) || chr(10) || 'Pregunta: ' || query)) || ' caracteres' AS answer,
          cited FROM questions JOIN ({_CONTEXT_SQL}) USING (query_id)
          JOIN (SELECT query_id, string_agg(title || '/' || chunk_id || '/' || snippet, '|' ORDER BY "rank") AS cited
                FROM citations GROUP BY query_id) USING (query_id)""",
    ("questions", "retrieved", "citations"), ("query_id", "answer", "cited"),
)
def r15_answers(spark, d):
    inputs = _retrieval_inputs(spark, d)
    answered = an.answer_questions(inputs[0], retrieve(*inputs), measure_prompt)
    cited = F.transform("citations", lambda c: F.concat_ws("/", c["doc_title"], c["chunk_id"], c["snippet"]))
    return answered.select("query_id", "answer", F.array_join(cited, "|").alias("cited"))


# memos: the linear score, its reasons, and citations for three of four applicants


def _evidence(spark, d):
    train, scorer = _linear_scorer(spark, d)
    wide, _ = at.linear_attributions(scorer, train, "SK_ID_CURR")
    scored = scorer.score(train).select(F.col("SK_ID_CURR").alias("id"), F.col("TARGET").alias("y"), "p")
    # four decimals keep the printed numbers the same on every engine
    exact = sc.score_records(scored, sc.rate_matched_threshold(scored))
    records = exact.withColumns({"probability": F.round("probability", 4), "threshold": F.round("threshold", 4)})
    reasons = wide.select(F.col("id").alias("sk_id_curr"), re_.reason_codes(NAMES, F.col("contributions")).alias("reason_codes"))
    cited = train.select(
        F.col("SK_ID_CURR").alias("sk_id_curr"),
        F.when(F.col("CNT_CHILDREN") > 0, F.array(F.struct(
            F.lit("Politica").alias("doc_title"), F.concat(F.lit("p::"), F.col("CNT_CHILDREN").cast("string")).alias("chunk_id"),
            F.concat(F.lit("Regla "), F.col("CNT_CHILDREN").cast("string")).alias("snippet"),
        ))).alias("citations"),
    ).where(F.col("citations").isNotNull())
    return rv.gather_evidence(records, reasons, cited)


_EVIDENCE_SQL = f"""SELECT s.id AS sk_id_curr, round(s.p, 4) AS probability, round(threshold, 4) AS threshold, decision,
      CASE WHEN decision = 'alto_riesgo' THEN reasons ELSE '' END AS reasons,
      CASE WHEN decision = 'alto_riesgo' AND CNT_CHILDREN > 0 THEN 'Regla ' || CNT_CHILDREN ELSE '' END AS cited
    FROM (SELECT id, p, CASE WHEN p >= threshold THEN 'alto_riesgo' ELSE 'riesgo_aceptable' END AS decision, threshold
          FROM linear_scored, linear_scored_cut) s JOIN ({_REASONS_SQL}) r ON s.id = r.id
    JOIN application a ON a.SK_ID_CURR = s.id"""
_EVIDENCE_VIEWS = ("application", "contributions", "linear_scored", "linear_scored_cut")


def _flat(evidence):
    return evidence.withColumns(
        {"reasons": F.array_join("reason_codes", " | "), "cited": F.array_join(F.transform("citations", lambda c: c["snippet"]), " | ")}
    )


@register("q1_evidence", _EVIDENCE_SQL, _EVIDENCE_VIEWS, ("sk_id_curr", "decision", "reasons", "cited"), ("probability", "threshold"))
def q1_evidence(spark, d):
    return _flat(_evidence(spark, d))


@register(
    "q1_retrieved_evidence",
    f"""WITH per_question AS (SELECT query_id, string_agg(title || '/' || chunk_id || '/' || snippet, '|' ORDER BY "rank") AS found FROM citations GROUP BY query_id)
        SELECT sk_id_curr, decision, reasons, CASE WHEN decision = 'alto_riesgo' THEN coalesce(found, '') ELSE '' END AS cited
        FROM ({_EVIDENCE_SQL}) LEFT JOIN per_question ON query_id = sk_id_curr % (SELECT count(*) FROM questions)""",
    (*_EVIDENCE_VIEWS, "questions", "citations"), ("sk_id_curr", "decision", "reasons", "cited"),
)
def q1_retrieved_evidence(spark, d):
    """Evidence with citations that are retrieved: every applicant has one of the policy questions, and high risk is cited."""
    records = cut_lineage(_evidence(spark, d))
    questions = proxy.policy_questions(spark, d)
    number = F.pmod(F.col("sk_id_curr"), F.lit(questions.count()))
    asked = records.where(F.col("decision") == defaults.HIGH_RISK).withColumn("query_id", number).join(questions, "query_id").select("sk_id_curr", "query")
    cited = policy_citations(asked, lambda queries: retrieve(*_retrieval_inputs(spark, d, cut_lineage(queries))))
    evidence = rv.gather_evidence(records.drop("reason_codes", "citations"), records.select("sk_id_curr", "reason_codes"), cited)
    listed = F.transform("citations", lambda c: F.concat_ws("/", c["doc_title"], c["chunk_id"], c["snippet"]))
    return _flat(evidence).withColumn("cited", F.array_join(listed, "|"))


_N = "chr(10)"
_PROMPT_SQL = f"""SELECT *, 'Score: sk_id_curr=' || sk_id_curr || ', probability=' || probability || ', threshold=' || threshold
      || ', decision=' || decision || {_N} || {_N} || 'Reason codes:' || {_N}
      || CASE WHEN reasons = '' THEN '{defaults.NO_REASONS}' ELSE '- ' || replace(reasons, ' | ', {_N} || '- ') END
      || {_N} || {_N} || 'Citas de politica:' || {_N}
      || CASE WHEN cited = '' THEN '{defaults.NO_CITATIONS}' ELSE '- [Politica] ' || cited END AS prompt
    FROM ({_EVIDENCE_SQL})"""


@register("q2_memo_input", _PROMPT_SQL, _EVIDENCE_VIEWS, ("sk_id_curr", "prompt"))
def q2_memo_input(spark, d):
    return _evidence(spark, d).select("sk_id_curr", rv.memo_input().alias("prompt"))


_FOUND_SQL = "list_filter([{}], lambda x: x IS NOT NULL)".format(
    ", ".join(f"CASE WHEN contains(lower({{memo}}), '{w}') THEN '{w}' END" for w in defaults.PROTECTED_WORDS)
)


def _issues_sql(memo: str, reasons: str, cited: str) -> str:
    found = _FOUND_SQL.format(memo=memo)
    return f"""array_to_string(list_filter([CASE WHEN trim({memo}) = '' THEN '{defaults.ISSUE_EMPTY}' END,
        CASE WHEN {reasons} <> '' AND len(string_split({reasons}, ' | ')) > 4 THEN '{defaults.ISSUE_REASONS}' END,
        CASE WHEN decision = 'alto_riesgo' AND {cited} = '' THEN '{defaults.ISSUE_NO_CITATION}' END,
        CASE WHEN len({found}) > 0 THEN '{defaults.ISSUE_PROTECTED}' || array_to_string({found}, ', ') END], lambda x: x IS NOT NULL), '; ')"""


@register(
    "q3_precheck", f"SELECT sk_id_curr, {_issues_sql('prompt', 'reasons', 'cited')} AS issues FROM ({_PROMPT_SQL})",
    _EVIDENCE_VIEWS, ("sk_id_curr", "issues"),
)
def q3_precheck(spark, d):
    """The drafting text stands for the memo."""
    memos = _evidence(spark, d).withColumn("memo", rv.memo_input())
    issues = rv.precheck(F.col("memo"), F.col("decision"), F.col("reason_codes"), F.col("citations"))
    return memos.select("sk_id_curr", F.array_join(issues, "; ").alias("issues"))


@register(
    "q3_protected_words",
    f"SELECT doc_id, array_to_string({_FOUND_SQL.format(memo='text')}, ',') AS words FROM documents", (), ("doc_id", "words"),
)
def q3_protected_words(spark, d):
    docs = proxy.given(spark, d, "documents")
    return docs.select("doc_id", F.array_join(rv.protected_words(F.col("text")), ",").alias("words"))


@register(
    "q4_verdicts",
    """SELECT doc_id, CASE WHEN toxic = 1 THEN NULL ELSE quality = 1 END AS approved,
         CASE WHEN toxic = 1 THEN NULL ELSE lang || ' ' || n_chars END AS feedback FROM labels JOIN documents USING (doc_id)""",
    (), ("doc_id", "approved", "feedback"),
)
def q4_verdicts(spark, d):
    """Labels as judge replies: quality is the verdict; a toxic one answers with a string instead of a boolean."""
    docs = proxy.given(spark, d, "documents").select("doc_id", "lang", "n_chars")
    joined = proxy.given(spark, d, "labels").join(docs, "doc_id")
    feedback = F.concat_ws(" ", "lang", "n_chars")
    good = F.to_json(F.struct((F.col("quality") == 1).alias("approved"), feedback.alias("feedback")))
    bad = F.to_json(F.struct(F.lit("false").alias("approved"), feedback.alias("feedback")))
    reply = F.when(F.col("toxic") == 1, bad).otherwise(F.concat(F.lit("```json\n"), good, F.lit("\n```")))
    return joined.select("doc_id", rv.parse_verdict(reply).alias("v")).select("doc_id", "v.approved", "v.feedback")


def copy_prompt(prompts: list[str]) -> list[str]:
    """Stand-in for the drafting model."""
    return ["Memo: " + p for p in prompts]


def judge_by_length(prompts: list[str]) -> list[str]:
    """Stand-in for the judge: memos of even length pass."""
    memos = [p.split("\n\nMemo:\n", 1)[1] for p in prompts]
    return ['{"approved": %s, "feedback": "largo %d"}' % ("true" if len(m) % 2 == 0 else "false", len(m)) for m in memos]


def _review(spark, d):
    return rv.review_batch(_evidence(spark, d), copy_prompt, judge_by_length)


def _pass_sql(source: str) -> str:
    return f"""SELECT *, CASE WHEN issues <> '' THEN issues ELSE 'largo ' || length(memo) END AS feedback,
          issues = '' AND length(memo) % 2 = 0 AS ok
        FROM (SELECT *, {_issues_sql('memo', 'reasons', 'cited')} AS issues FROM ({source}))"""


_REVIEW_SQL = f"""
    WITH first_pass AS ({_pass_sql(f"SELECT *, 'Memo: ' || prompt AS memo FROM ({_PROMPT_SQL})")}),
    second_pass AS ({_pass_sql(f'''SELECT sk_id_curr, decision, reasons, cited,
        'Memo: ' || prompt || {_N} || {_N} || '{defaults.REVISION_NOTE}' || {_N} || feedback AS memo FROM first_pass WHERE NOT ok''')})
    SELECT sk_id_curr, memo, feedback AS evaluator_feedback, 0 AS iteration, 'approved' AS status FROM first_pass WHERE ok
    UNION ALL SELECT sk_id_curr, memo, feedback, 1, CASE WHEN ok THEN 'approved' ELSE 'needs_human_review' END FROM second_pass"""


@register(
    "q5_review_batch", _REVIEW_SQL, _EVIDENCE_VIEWS, ("sk_id_curr", "memo", "evaluator_feedback", "iteration", "status")
)
def q5_review_batch(spark, d):
    return _review(spark, d)


@register(
    "q6_first_try_rate",
    f"""SELECT count(*) AS n, avg(CASE WHEN status = 'approved' AND iteration = 0 THEN 1 ELSE 0 END) AS first_try_rate
        FROM ({_REVIEW_SQL})""",
    _EVIDENCE_VIEWS, ("n",), ("first_try_rate",),
)
def q6_first_try_rate(spark, d):
    return rv.first_try_rate(_review(spark, d))


@register(
    "q7_token_usage",
    r"""SELECT role AS model, count(*) AS calls, CAST(sum(i) FILTER (WHERE has) AS BIGINT) AS input,
          CAST(sum(o) FILTER (WHERE has AND i % 3 <> 0) AS BIGINT) AS output, CAST(sum(i + o) FILTER (WHERE has) AS BIGINT) AS total
        FROM (SELECT role, len(regexp_extract_all(text, '\S+')) AS i, length(text) AS o, turn <> 1 AS has FROM conversations) GROUP BY role""",
    (), ("model", "calls", "input", "output", "total"),
)
def q7_token_usage(spark, d):
    """Turns as model calls: words in, characters out; some responses lack the output count, some all usage."""
    calls = proxy.given(spark, d, "conversations").select(
        F.col("role").alias("model"), "turn",
        F.size(F.regexp_extract_all(F.col("text"), F.lit(r"\S+"), 0)).alias("i"), F.length("text").alias("o"),
    )
    usage = F.struct(
        F.col("i").alias("prompt_tokens"), F.when(F.col("i") % 3 != 0, F.col("o")).alias("completion_tokens"),
        (F.col("i") + F.col("o")).alias("total_tokens"),
    )
    response = F.to_json(F.struct(F.lit("chat").alias("object"), F.when(F.col("turn") != 1, usage).alias("usage")))
    return rv.usage_totals(calls.select("model", rv.extract_usage(response).alias("usage")))


def _judged(spark, d):
    """Quality labels as the human verdict, a length rule as the judge's."""
    docs = proxy.given(spark, d, "documents").select("doc_id", "n_chars")
    return proxy.given(spark, d, "labels").join(docs, "doc_id").select(
        "doc_id", (F.col("quality") == 1).alias("human_approved"), (F.col("n_chars") >= 500).alias("predicted_approved")
    )


_JUDGED_SQL = "SELECT doc_id, quality = 1 AS h, n_chars >= 500 AS p FROM labels JOIN documents USING (doc_id)"


@register(
    "q8_judge_quality",
    f"""SELECT *, coalesce(tpr >= 0.9, false) AS tpr_ok, coalesce(tnr >= 0.9, false) AS tnr_ok FROM (
          SELECT *, tp / nullif(tp + fn, 0)::DOUBLE AS tpr, tn / nullif(tn + fp, 0)::DOUBLE AS tnr FROM (
            SELECT count(*) FILTER (WHERE h AND p) AS tp, count(*) FILTER (WHERE NOT h AND NOT p) AS tn,
              count(*) FILTER (WHERE NOT h AND p) AS fp, count(*) FILTER (WHERE h AND NOT p) AS fn FROM ({_JUDGED_SQL})))""",
    (), ("tp", "tn", "fp", "fn", "tpr_ok", "tnr_ok"), ("tpr", "tnr"),
)
def q8_judge_quality(spark, d):
    return rv.judge_quality(_judged(spark, d))


@register("q8_marks", f"SELECT doc_id, CASE WHEN h = p THEN 'OK' ELSE 'MAL' END AS mark FROM ({_JUDGED_SQL})", (), ("doc_id", "mark"))
def q8_marks(spark, d):
    return rv.mark_verdicts(_judged(spark, d))


@register(
    "q9_answer_quality",
    """SELECT avg(p) AS faithfulness, avg(y) AS relevancy, avg(p) >= 0.9 AS faithfulness_ok, avg(y) >= 0.85 AS relevancy_ok
       FROM scored_labels""",
    ("scored_labels",), ("faithfulness_ok", "relevancy_ok"), ("faithfulness", "relevancy"),
)
def q9_answer_quality(spark, d):
    scored = proxy.scored_labels(spark, d)
    return rv.answer_quality(scored.select(F.col("p").alias("faithfulness"), F.col("y").cast("double").alias("relevancy")))


# logs and drift


def _event_scores(spark, d):
    """Events as scores: the user, the value as probability, and the event's own time."""
    p = F.col("value") / 500
    return proxy.given(spark, d, "events").select(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("timestamp"),
        F.col("user_id").alias("sk_id_curr"), p.alias("probability"), F.lit(0.2).alias("threshold"),
        sc.decision(p, F.lit(0.2)).alias("decision"),
    )


LOG_EXACT = ("timestamp", "sk_id_curr", "decision")


@register(
    "io5_log_entries", """SELECT '2024-02-01T00:00:00+00:00' AS "timestamp", sk_id_curr, probability, threshold, decision FROM event_log""",
    ("event_log",), LOG_EXACT, ("probability", "threshold"),
)
def io5_log_entries(spark, d):
    return log_entries(_event_scores(spark, d), "2024-02-01T00:00:00+00:00")


def _written_log(spark, d):
    """The events appended to the log in two runs, as JSON lines."""
    path = _scratch(spark, "log")
    scores = _event_scores(spark, d)
    append_log(scores.where(F.col("decision") == defaults.HIGH_RISK), path)
    append_log(scores.where(F.col("decision") == defaults.LOW_RISK), path)
    return path


@register("io6_append_log", "SELECT * FROM event_log", ("event_log",), LOG_EXACT, ("probability", "threshold"))
def io6_append_log(spark, d):
    return read_log(spark, _written_log(spark, d))


@register(
    "io6_exactly_once_log", "SELECT * FROM event_log WHERE sk_id_curr IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')", ("event_log",), LOG_EXACT,
    ("probability", "threshold"),
)
def io6_exactly_once_log(spark, d):
    """Scores streamed into the log in batches; the stream is then run from the start again, which adds nothing. Only the customers of one segment are known."""
    incoming, store = _scratch(spark, "incoming"), LogStore(spark, _scratch(spark, "log"))
    _event_scores(spark, d).write.json(incoming)
    known = proxy.given(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("sk_id_curr"))
    entries = known_only(stream.stream_log(spark, incoming), known)
    for _ in range(2):
        start_log_store(entries, store, "events", _scratch(spark, "state")).awaitTermination()
    return store.read()


@register(
    "d4_log_summary",
    """SELECT decision, count(*) AS n, avg(probability) AS mean_probability, avg((probability >= threshold)::INTEGER) AS high_risk_share
       FROM event_log GROUP BY decision""",
    ("event_log",), ("decision", "n"), ("mean_probability", "high_risk_share"),
)
def d4_log_summary(spark, d):
    return summarize_log(read_log(spark, _written_log(spark, d)))


_WINDOW_SQL = """SELECT substr("timestamp", 1, 10) AS window_day, decision, count(*) AS n, avg(probability) AS mean_probability,
    avg((probability >= threshold)::INTEGER) AS high_risk_share FROM event_log GROUP BY window_day, decision"""
_WINDOW_DOUBLES = ("mean_probability", "high_risk_share")


@register("d4_windowed_log", _WINDOW_SQL, ("event_log",), ("window_day", "decision", "n"), _WINDOW_DOUBLES)
def d4_windowed_log(spark, d):
    windows = stream.windowed_summary(read_log(spark, _written_log(spark, d)))
    return windows.withColumn("window_day", F.date_format("window_start", "yyyy-MM-dd"))


@register(
    "d4_streamed_log",
    f"""SELECT * FROM ({_WINDOW_SQL}) WHERE strptime(window_day, '%Y-%m-%d') + INTERVAL 1 DAY <=
        (SELECT max(strptime(substr("timestamp", 1, 19), '%Y-%m-%dT%H:%M:%S')) - INTERVAL 2 HOUR FROM event_log)""",
    ("event_log",), ("window_day", "decision", "n"), _WINDOW_DOUBLES,
)
def d4_streamed_log(spark, d):
    """The same windows from a stream over the log files; windows the watermark has not passed stay open."""
    out, state = _scratch(spark, "windows"), _scratch(spark, "state")
    query = stream.start_summary(stream.stream_log(spark, _written_log(spark, d)), out, state)
    query.awaitTermination()
    windows = spark.read.schema(
        "window_start timestamp, decision string, n long, mean_probability double, high_risk_share double"
    ).parquet(out)
    return windows.withColumn("window_day", F.date_format("window_start", "yyyy-MM-dd"))


_EVENT_PSI = psi_sql("events", "(ts < TIMESTAMP '2024-01-16')", ("value", "user_id"), ("event_type",))


def _event_psi(spark, d):
    events = proxy.given(spark, d, "events")
    before = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    return dr.stability_index(events, ["value", "user_id", "event_type"], before)


@register("d1_event_drift", _EVENT_PSI, (), ("column",), ("psi",))
def d1_event_drift(spark, d):
    return _event_psi(spark, d)


_FEATURE_PSI = numeric_psi_sql("features", "(IS_TRAIN = 1)", FEATURE_INPUTS)


def _feature_psi(spark, d):
    """All columns of the feature table but id, label and split."""
    features = stored_features(spark, d)
    return dr.stability_index(features, feature_columns(features), F.col("IS_TRAIN") == 1)


@register("d1_feature_drift", _FEATURE_PSI, ("features",), ("column",), ("psi",))
def d1_feature_drift(spark, d):
    return _feature_psi(spark, d)


@register("d2_alerts", f"SELECT * FROM ({_FEATURE_PSI}) WHERE psi > 0.2", ("features",), ("column",), ("psi",))
def d2_alerts(spark, d):
    return dr.alert_columns(_feature_psi(spark, d))


@register(
    "d3_alert_report",
    f"""SELECT count(*) AS n_evaluated, count(*) FILTER (WHERE psi > 0.2) AS n_alerts,
          coalesce(string_agg("column", ',' ORDER BY round(psi, 9) DESC, "column") FILTER (WHERE psi > 0.2), '') AS alerts
        FROM ({_FEATURE_PSI})""",
    ("features",), ("n_evaluated", "n_alerts", "alerts"),
)
def d3_alert_report(spark, d):
    report = dr.alert_report(_feature_psi(spark, d))
    return report.withColumn("alerts", F.array_join(F.transform("alerts", lambda a: a["column"]), ","))
