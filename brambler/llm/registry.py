"""Queries of this subpackage and SQL for those that SQL can express over whole tables."""

from __future__ import annotations

from .bpe import op8_bpe
from .divergence import OP12_SQL, op12_source_divergence
from .embedding_dedup import OP3_SQL, op3_embedding_dedup
from .fill_in_middle import OP11_SQL, op11_fill_in_middle
from .langid import op6_language
from .line_dedup import OP7_SQL, op7_line_dedup
from .media import op9_media
from .mixing import op4_sainte_lague
from .passage_dedup import OP13_SQL, op13_passage_dedup
from .pii import op5_pii
from .setsketch import OP10_SQL, op10_setsketch
from .suffix_dedup import OP1_SQL, op1_suffix_dedup
from .toxicity import op2_toxicity

QUERIES = {"op1_suffix_dedup": op1_suffix_dedup, "op2_toxicity": op2_toxicity, "op3_embedding_dedup": op3_embedding_dedup, "op4_sainte_lague": op4_sainte_lague, "op5_pii": op5_pii, "op6_language": op6_language, "op7_line_dedup": op7_line_dedup, "op8_bpe": op8_bpe, "op9_media": op9_media, "op10_setsketch": op10_setsketch, "op11_fill_in_middle": op11_fill_in_middle, "op12_source_divergence": op12_source_divergence, "op13_passage_dedup": op13_passage_dedup}
ORACLE_SQL = {"op1_suffix_dedup": OP1_SQL, "op10_setsketch": OP10_SQL, "op3_embedding_dedup": OP3_SQL, "op7_line_dedup": OP7_SQL, "op11_fill_in_middle": OP11_SQL, "op12_source_divergence": OP12_SQL, "op13_passage_dedup": OP13_SQL}
