"""The training-data pipeline: quality rules, near duplicates, personal data,
mixing, packing.

Each stage maps a table with the columns of ``documents`` to another (the
last one to packed pieces: doc_id, piece, start, length, ids_crc32,
sequence_id, offset). Its output is written to the shared folder and read
again as the next one's input, so a stage works on all rows its predecessor
kept, and a lost executor never costs more than one stage.

- quality: documents that fail the rules go; lines above the host's limits are
  removed from the others.
- near_duplicates: one document of each class of 5-word shingle sets with a
  similarity of 0.8 or more stays, the one with the least id; and one of those
  without an id.
- personal_data: spans are replaced by their kind.
- mixing: documents are repeated, or left out, to meet the sources' targets.
- packing: texts are tokenised and packed into sequences.

SQL cannot express the stages as a whole; each is tested against a plainer
form of its own in tests/llm.
"""
from __future__ import annotations

from lodgeframe.llm import jaccard_join, line_quality, mixing, packing, pii
from lodgeframe.llm.staging import read_table, stage


def quality(spark, docs, sf_dir):
    return line_quality.clean(docs)


def near_duplicates(spark, docs, sf_dir):
    return jaccard_join.deduplicate(docs)


def personal_data(spark, docs, sf_dir):
    return pii.redact(docs)


def mix_sources(spark, docs, sf_dir):
    return mixing.mix(docs)


def pack(spark, docs, sf_dir):
    return packing.pack_documents(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mixing", mix_sources), ("packing", pack)]
ORACLE_SQL = None


def run(spark, sf_dir):
    """The packed pieces of ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
