"""The registered queries of this subpackage and their SQL where SQL can say it."""

from .alignment import op13_token_alignment
from .bpe import op2_byte_bpe
from .jaccard import op10_jaccard_join
from .language import op1_language_id
from .licenses import op8_license_scan
from .mixing import op6_source_mix
from .periodic import op12_periodic_runs
from .quality import op7_quality_rules
from .recipes import DEDUP_SQL, op11_exact_dedup
from .secrets import op5_secret_scan
from .sql import JACCARD_SQL, LICENSE_SQL, QUALITY_SQL, URL_SQL
from .tokenfile import op9_token_files
from .topk import OP4_SQL, op4_exact_topk
from .urls import op3_url_filter

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_url_filter": op3_url_filter,
    "op4_exact_topk": op4_exact_topk,
    "op5_secret_scan": op5_secret_scan,
    "op6_source_mix": op6_source_mix,
    "op7_quality_rules": op7_quality_rules,
    "op8_license_scan": op8_license_scan,
    "op9_token_files": op9_token_files,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_alignment": op13_token_alignment,
}
SQL: dict[str, str] = {
    "op3_url_filter": URL_SQL,
    "op4_exact_topk": OP4_SQL,
    "op7_quality_rules": QUALITY_SQL,
    "op8_license_scan": LICENSE_SQL,
    "op10_jaccard_join": JACCARD_SQL,
    "op11_exact_dedup": DEDUP_SQL,
}
