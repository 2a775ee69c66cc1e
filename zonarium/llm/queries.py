"""The registered queries of this subpackage, one for each operator, and their SQL."""

from pathlib import Path

from pyspark.sql import functions as F

from zonarium.llm import ann, audit, bpe, chat, common, fingerprint, htmltext, jaccard, langid, maxent, packing, prefixtrie, simhash, suffix

#: Vocabulary of op9; None: the file of the installed public vocabularies.
VOCABULARY = None


def vocabulary(path=VOCABULARY):
    """Text of the vocabulary file, read on the driver and sent to the tasks."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return Path(path).read_text(encoding="utf-8")


def op1_nearest_neighbours(spark, sf_dir):
    table = common.read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.nearest_neighbours(table, lambda i: F.pmod(i, F.lit(50)) == 0)


def op2_lm_scoring(spark, sf_dir):
    remainder = common.id_hash("doc_id") % 10
    return maxent.score_documents(common.read(spark, sf_dir, "documents", "doc_id", "text"), remainder != 0, remainder == 0)


def op3_html_main_text(spark, sf_dir):
    return htmltext.extract_main_text(common.read(spark, sf_dir, "pages"))


def op4_language_id(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = common.id_hash("doc_id") % 4 == 2
    model = langid.fit(docs, ~held_out)
    marked = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    return langid.predict(marked, model, keep=("doc_id", "held_out"))


def op5_ngram_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_join(common.read(spark, sf_dir, "documents", "doc_id", "text"))


def op6_best_fit_packing(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(docs, packing.word_count("text"))


def op7_suffix_array_dedup(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents", "doc_id", "text")
    return suffix.removal_report(docs, passage_words=suffix.PASSAGE_WORDS)


def op8_document_fingerprints(spark, sf_dir):
    return fingerprint.fingerprint_edits(common.read(spark, sf_dir, "documents", "doc_id", "text"))


def op9_bpe(spark, sf_dir):
    return bpe.encoding_digests(common.read(spark, sf_dir, "documents", "doc_id", "text"), vocabulary())


def op10_chat_perspectives(spark, sf_dir):
    return chat.rotate_perspectives(common.read(spark, sf_dir, "conversations"))


def op11_conversation_trie(spark, sf_dir):
    return prefixtrie.conversation_trie(common.read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op12_filter_audit(spark, sf_dir):
    docs = common.read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return audit.filter_audit(docs, common.read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op13_simhash(spark, sf_dir):
    return simhash.near_duplicates(common.read(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {
    "op1_nearest_neighbours": op1_nearest_neighbours,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_html_main_text": op3_html_main_text,
    "op4_language_id": op4_language_id,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_document_fingerprints": op8_document_fingerprints,
    "op9_bpe": op9_bpe,
    "op10_chat_perspectives": op10_chat_perspectives,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_filter_audit": op12_filter_audit,
    "op13_simhash": op13_simhash,
}
ORACLES = {
    "op10_chat_perspectives": chat.ORACLE,
    "op11_conversation_trie": prefixtrie.ORACLE,
    "op12_filter_audit": audit.ORACLE,
}
