"""Composite jobs (what a user of the reference runs), each one lineage
of DataFrame stages.  Stage row counts come from ``Observation``s that
ride along with the job's own action - no extra passes.

* ``harvest``    pages → gate → links → resolve → items → keep-first by URL
* ``catalogue``  items → keep-first → defaults → ids → table rows + vectors
* ``kb_load``    several item sources → shape check → normalise → brand →
                 ids → word gate → metadata → vectors
* ``load_catalogue``, ``load_knowledge``  the same into stored, bucketed tables
* ``file_load``  one JSON Lines file → cut solutions, flagged → vectors
* ``flow``       harvest → relevance → load → hybrid question
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import text as T
from ..functions import url as U
from ..operators import dedupe as D
from ..operators import delta as DT
from ..operators import embed as EM
from ..operators import items as I
from ..operators import pages as P
from ..operators import relevance as R
from ..operators import retrieve as RT
from ..operators import store as S
from ..schema import EMBEDDING_DIM, ITEM_DEFAULTS, KB_RECORD, PDF_RECORD, VECTOR
from ..session import materialize
from ..sources.feeds import read_jsonl
from ..sources.feeds import valid_shape as valid_keys

LANG_RE = r'(?i)<html[^>]*\slang="([^"]*)"'
LINK_PREFIX = "Document link: "


def rejected_pages(pages: DataFrame) -> DataFrame:
    """Pages that the gate drops, with the reason."""
    return P.page_gate(P.as_pages(pages)).where(F.col("gate").isNotNull()).select("page_id", "url", F.col("gate").alias("reason"))


def harvest(pages: DataFrame, doc_marker: str | None = None, suffix: str = ".pdf",
            prefix: str = LINK_PREFIX, default_product: str = ITEM_DEFAULTS["product"],
            default_category: str = ITEM_DEFAULTS["category"],
            observation: Observation | None = None) -> DataFrame:
    """Items from stored pages, one per distinct resolved link URL (the
    first in page/position order): ``product`` = anchor text, ``issue``
    = file stem of the href, ``solution`` = prefix + URL, ``category`` =
    page language, ``depth`` = crawl depth of the page."""
    p = P.passed(P.as_pages(pages)).withColumn("page_lang", F.regexp_extract("html", LANG_RE, 1))
    links = P.explode_links(P.with_links(p), keep=("page_id", "url", "depth", "page_lang"))
    if doc_marker:
        links = links.where(P.href_contains(F.col("href"), doc_marker))
    links = U.with_resolved(links, "url", "href", "abs_url")
    items = links.select(
        "page_id", F.col("pos").cast("long").alias("pos"),
        F.col("abs_url").alias("url"),
        T.or_default("text", default_product).alias("product"),
        T.or_default("page_lang", default_category).alias("category"),
        U.url_stem(F.col("href"), suffix).alias("issue"),
        F.col("depth"),
    ).withColumn("solution", T.template(prefix, F.col("url")))
    if observation is not None:
        items = items.observe(observation, F.count(F.lit(1)).alias("links"))
    # written once: keep-first reads the items twice, and the resolved url's
    # expression would be repeated wherever the url is compared
    items = materialize(items, "harvest")
    return D.dedupe_first(items, "url", ["page_id", "pos"], keep_null_keys=False)


def catalogue(items: DataFrame, order: str = "ordinal", brand: str = "generic",
              dim: int = EMBEDDING_DIM, start_id: int = 1):
    """Document catalogue load.  Returns ``(table_rows, vectors)``:
    PDF_RECORD-shaped rows (dense ids, one load timestamp) and VECTOR
    rows keyed ``doc_<ordinal>`` (stable across runs).  The embedding text
    is made of the raw fields, whole, and an item whose fields are all
    blank gets no vector; defaults are for the table.  Items without a url
    are ``catalogue_rejects``."""
    firsts = D.dedupe_first(items.where(~F.coalesce(F.col("url") == "", F.lit(True))), "url", order)
    raw = I.embed_text(firsts, "catalogue", "embed_text")
    rows = I.project_defaults(raw, ITEM_DEFAULTS).withColumn("created_at", F.current_timestamp())
    rows = S.assign_ids(rows, order, start=start_id)
    vec = EM.embed_hashed(rows.where(~T.is_blank("embed_text")), "embed_text", dim)
    vectors = vec.select(
        F.concat(F.lit("doc_"), F.col(order).cast("string")).alias("id"),
        F.col("embedding").cast("array<float>").alias("embedding"),
        I.vector_metadata(F.lit(brand), F.col("issue"), F.col("solution"), F.col("product"),
                          F.col("category"), F.col("url"), F.col("id"), gated=False).alias("metadata"),
    )
    table = rows.select("id", "url", "product", "category", "issue", "solution", "depth", "created_at")
    return table, vectors


def load_catalogue(items: DataFrame, table_root: str, vectors_root: str, order: str = "ordinal",
                   brand: str = "generic", dim: int = EMBEDDING_DIM, buckets: int = 64) -> tuple[DT.Report, DT.Report]:
    """Load a catalogue into its stored table (key ``url``, the stored row
    wins, new rows get the ids that follow) and its vectors (``doc_<id>``,
    replaced by the load's text): the two loads' reports.  The vectors are
    made of all items of the load, so a run that stopped between the two
    tables is made whole by the next; a second run adds nothing.  The items
    are read, not written, more than once: they must give the same rows each
    time (``DT.stage`` them first if they don't)."""
    spark = items.sparkSession
    DT.create(spark, table_root, PDF_RECORD, "url", buckets)
    DT.create(spark, vectors_root, VECTOR, "id", buckets)
    usable = items.where(~F.coalesce(F.col("url") == "", F.lit(True))).drop("id")
    marked = DT.marked(usable)
    keys = DT.keys_of(marked, "url", order)
    added = DT.insert_new(spark, table_root, I.project_defaults(marked.withColumn("created_at", F.current_timestamp()), ITEM_DEFAULTS), order, id_col="id", keys=keys)
    # keys alone are compared; the texts follow by their place
    firsts = keys.groupBy("url").agg(F.min(DT.PLACE).alias(DT.PLACE))
    ids = firsts.join(DT.read(spark, table_root, firsts).select("url", "id"), "url")
    placed = marked.withColumn(DT.PLACE, F.struct(F.col(order).alias("o"), F.col(DT.ROW).alias("r")))
    by = ("url", DT.PLACE)
    raw = I.embed_text(DT.follow(placed, ids, list(by), lambda both: (both.repartition(*by), ())), "catalogue", "embed_text")
    vec = EM.embed_hashed(I.project_defaults(raw, ITEM_DEFAULTS).where(~T.is_blank("embed_text")), "embed_text", dim)
    vectors = vec.select(
        F.concat(F.lit("doc_"), F.col("id").cast("string")).alias("id"),
        F.col("embedding").cast("array<float>").alias("embedding"),
        I.vector_metadata(F.lit(brand), F.col("issue"), F.col("solution"), F.col("product"),
                          F.col("category"), F.col("url"), F.col("id"), gated=False).alias("metadata"),
    )
    return added, DT.upsert(spark, vectors_root, vectors, None, rows=added.rows_in)


def catalogue_rejects(items: DataFrame) -> DataFrame:
    """The items that ``catalogue`` can't load, with the reason."""
    return items.where(F.coalesce(F.col("url") == "", F.lit(True))).withColumn("reason", F.lit("no_url"))


def has_shape(df: DataFrame) -> Column:
    """Record shape of each row: (issue or title) and (solution or
    description).  Where the feed kept the ``keys`` of a record their
    presence counts; else a field that is not null."""
    if "keys" in df.columns:
        return valid_keys(F.col("keys"))
    some = lambda *names: F.coalesce(*[F.when(F.col(c).isNotNull(), True) for c in names if c in df.columns], F.lit(False))
    return some("issue", "title") & some("solution", "description")


def valid_shape(df: DataFrame) -> DataFrame:
    return df.where(has_shape(df))


def shape_rejects(df: DataFrame) -> DataFrame:
    return df.where(~has_shape(df)).withColumn("reason", F.lit("shape"))


def kb_load(sources: Sequence[DataFrame], brands: Mapping[str, str], default_brand: str,
            source_col: str = "source", order: str = "ordinal", dim: int = EMBEDDING_DIM):
    """Knowledge load from several sources.  Returns ``(kb_rows,
    vectors)``; ids are dense in source order then ``order``; vector ids
    are content hashes so a re-run upserts instead of duplicating."""
    u = knowledge_items(sources, brands, default_brand, source_col)
    if u.isEmpty():  # nothing to load: skip the id layout and the vectors (one-row probe)
        empty = u.sparkSession.createDataFrame([], KB_RECORD)
        return empty, u.sparkSession.createDataFrame([], VECTOR)
    rows = S.assign_ids(u.withColumn("__ord", F.struct("__src", order)), "__ord")
    kb = rows.select("id", "brand", "issue", "solution", "product", "category", "url")
    return kb, knowledge_vectors(kb, dim)


def knowledge_items(sources: Sequence[DataFrame], brands: Mapping[str, str], default_brand: str,
                    source_col: str = "source") -> DataFrame:
    """The usable items of all sources with their brand and ``__src``."""
    if not sources:
        raise ValueError("a knowledge load needs at least one source")
    tagged = []
    for i, s in enumerate(sources):
        tagged.append(I.normalise_keys(valid_shape(s)).withColumn("__src", F.lit(i)))
    u = tagged[0]
    for t in tagged[1:]:
        u = u.unionByName(t, allowMissingColumns=True)
    return u.withColumn("brand", I.brand_column(F.col(source_col), brands, default_brand))


def knowledge_vectors(kb: DataFrame, dim: int = EMBEDDING_DIM) -> DataFrame:
    """VECTOR rows of knowledge rows; those without text have none."""
    kbt = I.embed_text(kb, "branded", "t").withColumn("t", T.ustrip("t")).where(F.col("t") != "")
    return EM.embed_hashed(kbt, "t", dim).select(
        vector_id().alias("id"),
        F.col("embedding").cast("array<float>").alias("embedding"),
        I.vector_metadata(F.col("brand"), F.col("issue"), F.col("solution"), F.col("product"),
                          F.col("category"), F.col("url"), F.col("id")).alias("metadata"),
    )


def vector_id() -> Column:
    """A hash of all fields that make a knowledge record, nulls kept apart."""
    return F.sha2(F.to_json(F.struct("brand", "url", "product", "issue", "solution"), {"ignoreNullFields": "false"}), 256)


def load_knowledge(sources: Sequence[DataFrame], brands: Mapping[str, str], default_brand: str, table_root: str,
                   vectors_root: str, source_col: str = "source", order: str = "ordinal", dim: int = EMBEDDING_DIM,
                   buckets: int = 64) -> tuple[DT.Report, DT.Report]:
    """Load knowledge from several sources into its stored table and its
    vectors, both keyed by the record's hash (``vector_id``): the two loads'
    reports.  Records stored before keep their ids; new ones get those that
    follow, in source order then ``order``.  A second run adds nothing.  The
    sources must give the same rows whenever they are read."""
    u = knowledge_items(sources, brands, default_brand, source_col)
    spark = u.sparkSession
    DT.create(spark, table_root, StructType([*KB_RECORD.fields, StructField("key", StringType())]), "key", buckets)
    DT.create(spark, vectors_root, VECTOR, "id", buckets)
    rows = DT.marked(u.drop("id").withColumn("key", vector_id()).withColumn("__ord", F.struct("__src", order)))
    keys = DT.keys_of(rows, "key", "__ord")
    added = DT.insert_new(spark, table_root, rows, "__ord", id_col="id", keys=keys)
    loaded = DT.read(spark, table_root, keys)
    return added, DT.upsert(spark, vectors_root, knowledge_vectors(loaded, dim), None, rows=added.rows_in)


SOLUTION_CUT = 10_000


def cut_vectors(items: DataFrame, cut: int = SOLUTION_CUT, dim: int = EMBEDDING_DIM) -> DataFrame:
    """VECTOR rows of ``items`` whose solutions are cut to ``cut``
    characters before they are embedded and stored, with ``truncated`` and
    the whole solution's ``solution_chars``.  Missing fields are ''; an item
    without text gets no vector.  The id hashes the whole record, so equal
    records are one vector and a re-run replaces it."""
    names = ("issue", "solution", "product", "category", "url")
    whole = items.select(*[F.coalesce(F.col(c).cast("string") if c in items.columns else F.lit(None), F.lit("")).alias(c) for c in names])
    cutted = whole.select(
        F.sha2(F.to_json(F.struct(*names)), 256).alias("id"), "issue", T.truncate("solution", cut).alias("solution"), "product", "category", "url",
        T.was_truncated("solution", cut).alias("truncated"), F.char_length("solution").cast("long").alias("solution_chars"))
    text = I.embed_text(cutted.dropDuplicates(["id"]), "kb", "t").where(~T.is_blank("t"))
    return EM.embed_hashed(text, "t", dim).select(
        "id", F.col("embedding").cast("array<float>").alias("embedding"),
        I.vector_metadata(F.lit(None).cast("string"), F.col("issue"), F.col("solution"), F.col("product"), F.col("category"), F.col("url"), F.lit(None), gated=False).alias("metadata"),
        "truncated", "solution_chars")


def file_load(spark, path: str, stored: DataFrame | None = None, cut: int = SOLUTION_CUT,
              dim: int = EMBEDDING_DIM) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Load one JSON Lines file: (the vectors after the upsert into
    ``stored``, the urls whose solutions were cut, the malformed lines)."""
    feed = read_jsonl(spark, path)
    fresh = materialize(cut_vectors(feed.records, cut, dim), "file-load")
    cut_rows = fresh.where("truncated").select("id", "metadata.url", "solution_chars")
    vectors = fresh.select("id", "embedding", "metadata")
    return (vectors if stored is None else S.upsert(stored, vectors, "id")), cut_rows, feed.rejects


def page_items(pages: DataFrame, default_product: str = ITEM_DEFAULTS["product"]) -> DataFrame:
    """One item per stored page: title as issue, its whole paragraph text
    as solution."""
    p = P.with_title(P.passed(P.as_pages(pages)))
    return p.select(
        "page_id", F.lit(0).cast("long").alias("pos"), "url", F.col("title").alias("issue"),
        P.joined_paragraphs("html").alias("solution"), F.lit(default_product).alias("product"))


def load(table: DataFrame, vectors: DataFrame, new: DataFrame, order: str = "ordinal",
         dim: int = EMBEDDING_DIM) -> tuple[DataFrame, DataFrame]:
    """What a load adds to a stored knowledge table and its vectors: rows
    whose vector id isn't stored yet (first of each, in input order) with
    the ids that follow the stored ones, and the vectors after the upsert.
    ``new`` has brand, url, product, issue, solution and ``order``; a second
    run of the same load adds nothing."""
    keyed = new.withColumn("key", vector_id())
    stored = table.select(vector_id().alias("key"))
    rows = S.assign_ids(S.insert_if_absent(stored, keyed, "key", order), order, start=S.next_id(table))
    text = I.embed_text(rows, "branded", "t").where(~T.is_blank("t"))
    fresh = EM.embed_hashed(text, "t", dim).select(
        F.col("key").alias("id"), F.col("embedding").cast("array<float>").alias("embedding"),
        I.vector_metadata(F.col("brand"), F.col("issue"), F.col("solution"), F.col("product"),
                          F.lit(None).cast("string"), F.col("url"), F.col("id"), gated=False).alias("metadata"))
    return rows.select("id", "brand", "url", "product", "issue", "solution"), S.upsert(vectors, fresh, "id")


def flow(pages: DataFrame, question: str, keyword: str, brand: str = "generic",
         dim: int = EMBEDDING_DIM, topics=R.TOPICS) -> DataFrame:
    """Scrape -> filter -> load -> query over stored pages.  The relevant
    items are loaded into an empty knowledge table; the stage counts and the
    answer are computed from what was written.  Returns the stage messages
    as rows ``(step_no, step, message)``."""
    spark = pages.sparkSession
    # Every later step reads the judged items: write them once.
    judged = materialize(R.topic_rule(page_items(pages), "solution", topics), "flow-items")
    kept = judged.where("relevant").select(
        F.lit(brand).alias("brand"), "solution", "product", "issue", "url",
        F.struct("page_id", "pos").alias("ordinal"))
    empty = spark.createDataFrame([], "id long, brand string, url string, product string, issue string, solution string")
    none = spark.createDataFrame([], VECTOR)
    rows, vectors = load(empty, none, kept, dim=dim)
    rows, vectors = materialize(rows, "flow-table"), materialize(vectors, "flow-vectors")
    q = spark.range(1).select(F.lit(0).cast("long").alias("query_id"),
                              EM.hashed_embedding(F.lit(question), dim).alias("embedding"))
    near = vectors.select(F.col("metadata.db_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"))
    heads = rows.select("id", T.truncate(F.col("solution"), 100).alias("head"))
    top = RT.topk_cosine(near, q, k=1).join(heads, "id").agg(F.max("head").alias("va"))
    kwq = spark.range(1).select(F.lit(0).cast("long").alias("query_id"), F.lit(keyword).alias("keyword"))
    kw = RT.keyword_first_match(rows.select("id", "solution"), kwq, "solution", "id", answer_chars=100).agg(F.max("answer").alias("ka"))
    n_items = judged.agg(F.count(F.lit(1)).alias("n"), F.count_if("relevant").alias("kept"))
    n_loaded = rows.agg(F.count(F.lit(1)).alias("loaded"))
    one = n_items.join(n_loaded).join(top).join(kw)  # one row each
    answer = RT.hybrid_answer(F.col("va"), F.col("ka"), cut=100)
    steps = [("scrape", F.concat(F.lit("Harvested "), F.col("n").cast("string"), F.lit(" items"))),
             ("filter", F.concat(F.lit("Filtered to "), F.col("kept").cast("string"), F.lit(" items"))),
             ("load", F.concat(F.lit("Loaded "), F.col("loaded").cast("string"), F.lit(" items"))),
             ("query", answer)]
    rows_out = F.array(*[F.struct(F.lit(i).alias("step_no"), F.lit(s).alias("step"), m.alias("message")) for i, (s, m) in enumerate(steps)])
    return one.select(F.explode(rows_out).alias("s")).select("s.step_no", "s.step", "s.message")
