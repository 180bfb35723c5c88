"""Hybrid retrieval: exact dense recall, sparse scores, weighted fusion, token search.

Dense recall compares a set of queries with the whole index in blocks: at most QUERY_BLOCK queries at a time, fewer where k is large, so that
queries times kept and new scores stay below CELLS, go to the tasks as one matrix, each task keeps its best k per query while it reads its part of the index once, and only these are shuffled. Sparse
and token scores are equi-joins on tokens with sums that combine before the shuffle. Every ranking is total: ties by id.

Defined results: null vectors and vectors of another length than the query's score nothing; null texts have no token; scores are
doubles, rounded only on request.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litweave.session import cut

QUERY_BLOCK = 20_000
CELLS = 8 << 20
PART = 2048


def dense_recall(queries: DataFrame, index: DataFrame, query_id: str, doc_id: str, query_vector: str, doc_vector: str, k: int, score_as: str = "dot") -> DataFrame:
    """(query_id, doc_id, score) of the k documents with the largest score for each query.

    score_as: dot (the dot product as it is), or cosine01 ((1 + cosine) / 2, as search engines give it for normalised vectors;
    a vector of zeros has cosine 0).
    """
    if score_as not in ("dot", "cosine01"):
        raise ValueError(score_as)
    unit = score_as == "cosine01"
    q = queries.select(F.col(query_id).cast("bigint").alias("q"), F.col(query_vector).alias("v")).dropna()
    blocks = max(1, -(-q.count() // max(1, min(QUERY_BLOCK, CELLS // (k + PART)))))
    parts = []
    for b in range(blocks):
        block = q.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b).toPandas()
        ids = block["q"].to_numpy(np.int64)
        matrix = np.array(block["v"].tolist(), np.float64) if len(block) else np.zeros((0, 0))
        matrix = of_length_one(matrix) if unit and matrix.size else matrix

        def each(batches: Iterator[pd.DataFrame], ids: np.ndarray = ids, matrix: np.ndarray = matrix) -> Iterator[pd.DataFrame]:
            score = np.full((len(ids), 0), -np.inf)
            doc = np.zeros((len(ids), 0), np.int64)
            for batch in batches:
                for at in range(0, len(batch), PART):
                    part = batch.iloc[at : at + PART]
                    part = part[[v is not None and matrix.ndim == 2 and len(v) == matrix.shape[1] for v in part["v"]]]
                    if not len(part) or not len(ids):
                        continue
                    given = np.array(part["v"].tolist(), np.float64)
                    new = (1 + matrix @ of_length_one(given).T) / 2 if unit else matrix @ given.T
                    score = np.concatenate([score, new], 1)
                    doc = np.concatenate([doc, np.broadcast_to(part["d"].to_numpy(np.int64), new.shape)], 1)
                    if score.shape[1] > k:
                        # By score, then id: the id decides among equals at the border as well.
                        keep = np.lexsort((doc, -score), axis=1)[:, :k]
                        score, doc = np.take_along_axis(score, keep, 1), np.take_along_axis(doc, keep, 1)
            n = score.shape[1]
            yield pd.DataFrame({"q": np.repeat(ids, n), "d": doc.ravel(), "score": score.ravel()})

        docs = index.select(F.col(doc_id).cast("bigint").alias("d"), F.col(doc_vector).alias("v"))
        parts.append(docs.mapInPandas(each, "q bigint, d bigint, score double"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return top_k(out, ["q"], k, F.col("score").desc(), F.col("d")).select(F.col("q").alias(query_id), F.col("d").alias(doc_id), "score")


def of_length_one(rows: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(n == 0, 1, n)


def top_k(rows: DataFrame, keys: list[str], k: int, *order: Column) -> DataFrame:
    """The first k rows per key with their rank; the limit is pushed below the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def sparse_weights(rows: DataFrame, row_id: str, weights: str) -> DataFrame:
    """(id, token, weight) of positive weights."""
    return rows.select(row_id, F.explode(F.map_filter(weights, lambda _, w: w > 0)).alias("token", "weight"))


def sparse_scores(queries: DataFrame, docs: DataFrame, query_id: str, doc_id: str) -> DataFrame:
    """(query_id, doc_id, sparse): sum of products over shared tokens; both sides are (id, token, weight)."""
    met = queries.select(query_id, "token", F.col("weight").alias("wq")).join(docs.select(doc_id, "token", F.col("weight").alias("wd")), "token")
    return met.groupBy(query_id, doc_id).agg(F.sum(F.col("wq") * F.col("wd")).alias("sparse"))


def fuse(hits: DataFrame, query_id: str, doc_id: str, w_dense: float = 0.5, w_sparse: float = 0.5, digits: int | None = None) -> DataFrame:
    """hits(query, doc, dense, sparse) with score and the three ranks; each part is divided by its largest value per query."""
    over = Window.partitionBy(query_id)

    def part(c: str) -> Column:
        top = F.max(c).over(over)
        return F.col(c) / F.when(top == 0, 1e-9).otherwise(top)

    scored = hits.withColumn("score", w_dense * part("dense") + w_sparse * part("sparse"))
    if digits is not None:
        scored = scored.withColumn("score", F.round("score", digits))
    for name, c in (("dense_rank", "dense"), ("sparse_rank", "sparse"), ("rank", "score")):
        scored = scored.withColumn(name, F.row_number().over(over.orderBy(F.col(c).desc(), F.col(doc_id))))
    return scored


def hybrid_search(queries: DataFrame, index: DataFrame, query_sparse: DataFrame, index_sparse: DataFrame, query_id: str, doc_id: str, vector: str, k: int = 10, recall: int = 200, w_dense: float = 0.5, w_sparse: float = 0.5, digits: int | None = None, score_as: str = "dot", source: list[str] | None = None) -> DataFrame:
    """Dense recall, sparse scores of what was recalled, fusion, and the best k of each query, with the index columns in `source`.

    Only pairs that were recalled are scored: the tokens of their queries are looked up in their documents.
    """
    dense = cut(dense_recall(queries, index, query_id, doc_id, vector, vector, recall, score_as).withColumnRenamed("score", "dense"))
    asked = dense.select(query_id, doc_id).join(query_sparse.select(query_id, "token", F.col("weight").alias("wq")), query_id)
    met = asked.join(index_sparse.select(doc_id, "token", F.col("weight").alias("wd")), [doc_id, "token"])
    sparse = met.groupBy(query_id, doc_id).agg(F.sum(F.col("wq") * F.col("wd")).alias("sparse"))
    hits = dense.join(sparse, [query_id, doc_id], "left").fillna({"sparse": 0.0})
    best = fuse(hits, query_id, doc_id, w_dense, w_sparse, digits).where(F.col("rank") <= k)
    return best.join(index.select(doc_id, *source), doc_id) if source else best


def tokens(rows: DataFrame, row_id: str, text: str, *keep: str) -> DataFrame:
    """(id, token) of the words in small letters, repeated ones repeatedly."""
    ws = F.filter(F.split(F.lower(F.trim(text)), r"\s+"), lambda w: w != "")
    return rows.select(row_id, *keep, F.explode(ws).alias("token"))


def token_search(queries: DataFrame, index: DataFrame, query_id: str, query: str, entry: str, doc_id: str, name: str, k: int = 10) -> DataFrame:
    """Entries that share words with a query: score 100 x matched - words of the entry, the best k entries, one per id.

    index has one row per name (entry is its key; a doc_id may have several). The score is divided by the query's best; what
    is left after keeping the best entry per id is ranked again.
    """
    counted = index.select(entry, doc_id, name).withColumn("n_tokens", F.size(F.filter(F.split(F.lower(F.trim(name)), r"\s+"), lambda w: w != "")))
    q = tokens(queries, query_id, query).groupBy(query_id, "token").agg(F.count("*").alias("times"))
    d = tokens(index, entry, name).distinct()
    matched = q.join(d, "token").groupBy(query_id, entry).agg(F.sum("times").alias("matched"))
    scored = matched.join(counted, entry).withColumn("raw", F.col("matched") * 100 - F.col("n_tokens"))
    best = top_k(scored, [query_id], k, F.col("raw").desc(), F.col(entry))
    one = top_k(best.drop("rank"), [query_id, doc_id], 1, F.col("raw").desc(), F.col(entry)).drop("rank")
    top = F.max("raw").over(Window.partitionBy(query_id))
    ranked = one.withColumn("score", F.col("raw") / F.when(top == 0, 1e-9).otherwise(top))
    return ranked.withColumn("rank", F.row_number().over(Window.partitionBy(query_id).orderBy(F.col("raw").desc(), F.col(entry))))


def fuzzy_search(queries: DataFrame, index: DataFrame, query_id: str, query: str, doc_id: str, fields: dict[str, float], k: int = 10) -> DataFrame:
    """Entries one of whose weighted fields has a word near the query's: distance 0 up to 2 letters, 1 up to 5, else 2.

    Candidates meet on keys that any two near words share, so the edit distance is computed only for pairs that can be near.
    """
    q = tokens(queries, query_id, query).withColumn("key", F.explode(_near_keys(F.col("token"))))
    parts = [
        tokens(index.select(doc_id, F.col(f).alias("text")), doc_id, "text").withColumn("boost", F.lit(w)) for f, w in fields.items()
    ]
    d = parts[0]
    for p in parts[1:]:
        d = d.unionByName(p)
    d = d.withColumnRenamed("token", "word").withColumn("key", F.explode(_near_keys(F.col("word"))))
    most = F.when(F.length("token") <= 2, 0).when(F.length("token") <= 5, 1).otherwise(2)
    met = q.join(d, "key").drop("key").distinct().withColumn("d", F.levenshtein("token", "word")).where(F.col("d") <= most)
    per_word = met.groupBy(query_id, doc_id, "token").agg(F.max(F.col("boost") / (1 + F.col("d"))).alias("s"))
    sums = per_word.groupBy(query_id, doc_id).agg(F.sum("s").alias("raw"))
    top = F.max("raw").over(Window.partitionBy(query_id))
    return top_k(sums.withColumn("score", F.round(F.col("raw") / top, 3)), [query_id], k, F.col("raw").desc(), F.col(doc_id))


def _near_keys(word: Column) -> Column:
    """The word and what is left of it without one letter, and without two if it has more than five: two words within the distance allowed share one."""

    def left_out(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda i: F.concat(F.left(w, i - 1), F.substr(w, i + 1)))

    one = left_out(word)
    two = F.flatten(F.transform(F.array_distinct(one), left_out))
    return F.array_distinct(F.concat(F.array(word), one, F.when(F.length(word) > 3, two).otherwise(F.array().cast("array<string>"))))


def index_text(label: Column, synonyms: Column) -> Column:
    """`label; Synonyms: a; b`."""
    return F.concat_ws("; ", label, F.when(F.size(synonyms) > 0, F.concat(F.lit("Synonyms: "), F.array_join(synonyms, "; "))))


def description(*parts: Column) -> Column:
    """Parts joined by bars, lists sorted and without repeats."""
    return F.concat_ws(" | ", *parts)


def sorted_names(names: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(names)), ", ")


def hashed_tokens(text: Column, size: int = 64) -> Column:
    """A deterministic stand-in for a dense encoder: counts of hashed words, normalised to length one."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import zlib

        for b in batches:
            out = []
            for t in b:
                v = np.zeros(size)
                for w in (t or "").lower().split():
                    v[zlib.crc32(w.encode()) % size] += 1
                n = np.linalg.norm(v)
                out.append((v / n if n else v).astype("float32").tolist())
            yield pd.Series(out)

    return encode(text)


def build_index(rows: DataFrame, doc_id: str, label: str, text: Column, path: str, encoder: Callable[[Column], Column] = hashed_tokens) -> None:
    """Write an index table (id, label, text_all, sparse, vector); tokens with a stop are left out. The encoder is injected."""
    counts = F.split(F.lower(text), r"\s+")
    distinct = F.array_distinct(F.filter(counts, lambda w: (w != "") & ~w.contains(".")))
    sparse = F.map_from_arrays(distinct, F.transform(distinct, lambda w: F.size(F.filter(counts, lambda x: x == w)).cast("double")))
    rows.select(F.col(doc_id).alias("id"), F.col(label).alias("label"), text.alias("text_all"), sparse.alias("sparse"), encoder(text).alias("vector")).write.mode("overwrite").parquet(path)
