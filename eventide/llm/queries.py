"""One registered query per operator, over its whole table, and the DuckDB twin where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.llm import align, chat, divergence, fingerprint, jaccard, linededup, lm, mixing, packing, quality, tokenfile, topk, toxicity
from eventide.llm.common import read_table, shared_dir

QUERIES, ORACLE = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality(spark, sf_dir):
    out = quality.quality_verdicts(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "failed_rules")


@query
def op2_token_files(spark, sf_dir):
    folder = shared_dir(spark, "tokens")
    tokenfile.write_tokens(read_table(spark, sf_dir, "documents"), folder)
    return tokenfile.read_tokens(spark, folder, with_ids=False).drop("ids")


@query
def op3_chat(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_chats(rows))


ORACLE["op3_chat"] = chat.ORACLE


def toxicity_model(docs, labels):
    return toxicity.train(docs, labels, ~toxicity.held_out(F.col("doc_id")))


@query
def op4_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    scores = toxicity.score_documents(docs, toxicity_model(docs, read_table(spark, sf_dir, "labels")))
    return scores.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op5_topk(spark, sf_dir):
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE["op5_topk"] = topk.ORACLE


@query
def op6_lm_scoring(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    scored = lm.score_documents(docs, trains=~lm.held_out(F.col("doc_id")))
    return scored.select("doc_id", lm.held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


@query
def op7_jaccard_join(spark, sf_dir):
    return jaccard.near_copy_classes(read_table(spark, sf_dir, "documents")).drop("n_texts")


ORACLE["op7_jaccard_join"] = jaccard.ORACLE


@query
def op8_packing(spark, sf_dir):
    return packing.packing_digest(packing.pack_documents(read_table(spark, sf_dir, "documents")))


@query
def op9_line_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs, counts=True)


ORACLE["op9_line_dedup"] = linededup.ORACLE


@query
def op10_mixing(spark, sf_dir):
    return mixing.mix_plan_rows(mixing.plan_mix(read_table(spark, sf_dir, "documents")))


ORACLE["op10_mixing"] = mixing.ORACLE


@query
def op11_fingerprints(spark, sf_dir):
    return fingerprint.fingerprint_digest(fingerprint.edited_texts(read_table(spark, sf_dir, "documents")))


ORACLE["op11_fingerprints"] = fingerprint.ORACLE


@query
def op12_tokenizer_alignment(spark, sf_dir):
    return align.align_corpus(read_table(spark, sf_dir, "documents"))[0]


@query
def op13_source_divergence(spark, sf_dir):
    return divergence.audit_rows(divergence.audit(read_table(spark, sf_dir, "documents")))


ORACLE["op13_source_divergence"] = divergence.ORACLE
