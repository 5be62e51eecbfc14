"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from functools import wraps

from fiscalis.llm.common import bounded_batches
from fiscalis.llm.decontaminate import op3_decontamination
from fiscalis.llm.fingerprint import op5_document_fingerprints
from fiscalis.llm.hardneg import SQL_OP13, op13_hard_negatives
from fiscalis.llm.lines import op4_line_dedup
from fiscalis.llm.packing import op8_bestfit_packing
from fiscalis.llm.resample import SQL_OP12, op12_importance_resampling
from fiscalis.llm.secrets import op2_secret_scan
from fiscalis.llm.simhash import op1_simhash_neardup
from fiscalis.llm.substring import op6_substring_dedup
from fiscalis.llm.topk import SQL_OP11, op11_exact_topk
from fiscalis.llm.toxicity import op9_toxicity_fm
from fiscalis.llm.urlfilter import op7_url_filter
from fiscalis.llm.warc import SQL_OP10, op10_warc_revisits

_OPS = {
    "op1_simhash_neardup": op1_simhash_neardup,
    "op2_secret_scan": op2_secret_scan,
    "op3_decontamination": op3_decontamination,
    "op4_line_dedup": op4_line_dedup,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_bestfit_packing": op8_bestfit_packing,
    "op9_toxicity_fm": op9_toxicity_fm,
    "op10_warc_revisits": op10_warc_revisits,
    "op11_exact_topk": op11_exact_topk,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_hard_negatives": op13_hard_negatives,
}


def _bounded(query):
    @wraps(query)
    def run(spark, sf_dir):
        bounded_batches(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {name: _bounded(query) for name, query in _OPS.items()}
SQL: dict[str, str] = {
    "op10_warc_revisits": SQL_OP10,
    "op11_exact_topk": SQL_OP11,
    "op12_importance_resampling": SQL_OP12,
    "op13_hard_negatives": SQL_OP13,
}
