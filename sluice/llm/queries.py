"""The registered queries of the operators and their SQL."""

from sluice.llm.conversations import op11_conversations
from sluice.llm.decontamination import OP10_SQL, op10_decontamination
from sluice.llm.language_id import op8_language_id
from sluice.llm.line_dedup import OP4_SQL, op4_line_dedup
from sluice.llm.mixing import OP2_SQL, op2_mixing
from sluice.llm.neighbours import op1_neighbours
from sluice.llm.quality_rules import op12_quality_rules
from sluice.llm.simhash import op6_simhash
from sluice.llm.spelling import op13_spelling_variants
from sluice.llm.suffix_dedup import op3_suffix_dedup
from sluice.llm.token_counts import op9_token_counts
from sluice.llm.toxicity import op5_toxicity
from sluice.llm.warc import OP7_SQL, op7_warc

QUERIES = {"op1_neighbours": op1_neighbours, "op2_mixing": op2_mixing, "op3_suffix_dedup": op3_suffix_dedup, "op4_line_dedup": op4_line_dedup, "op5_toxicity": op5_toxicity, "op6_simhash": op6_simhash, "op7_warc": op7_warc,
           "op8_language_id": op8_language_id, "op9_token_counts": op9_token_counts, "op10_decontamination": op10_decontamination, "op11_conversations": op11_conversations, "op12_quality_rules": op12_quality_rules,
           "op13_spelling_variants": op13_spelling_variants}
ORACLE = {"op2_mixing": OP2_SQL, "op4_line_dedup": OP4_SQL, "op7_warc": OP7_SQL, "op10_decontamination": OP10_SQL}
