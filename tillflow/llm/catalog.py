"""Queries of the training-data operators: name -> job(spark, sf_dir) -> DataFrame, and oracle SQL."""

from __future__ import annotations

from tillflow.llm.align import op13_align
from tillflow.llm.decontaminate import op10_decontaminate
from tillflow.llm.embeddings import op3_embeddings
from tillflow.llm.harmonic import op12_harmonic
from tillflow.llm.packing import op6_packing
from tillflow.llm.quality import op2_quality
from tillflow.llm.repair import op11_repair
from tillflow.llm.secrets import op4_secrets
from tillflow.llm.simhash import op1_simhash
from tillflow.llm.suffix_dedup import op5_suffix_dedup
from tillflow.llm.toxicity import op7_toxicity
from tillflow.llm.urls import op9_url_filter
from tillflow.llm.warc import op8_warc

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_embeddings": op3_embeddings,
    "op4_secrets": op4_secrets,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_warc": op8_warc,
    "op9_url_filter": op9_url_filter,
    "op10_decontaminate": op10_decontaminate,
    "op11_repair": op11_repair,
    "op12_harmonic": op12_harmonic,
    "op13_align": op13_align,
}

ORACLE: dict[str, str] = {}
