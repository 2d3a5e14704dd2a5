"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from sitewise.llm.chat import OP4_SQL, op4_chat
from sitewise.llm.decontaminate import op6_decontaminate
from sitewise.llm.fim import OP11_SQL, op11_fim
from sitewise.llm.lines import OP13_SQL, op13_lines
from sitewise.llm.packing import op9_packing
from sitewise.llm.pii import op8_pii
from sitewise.llm.quality import OP5_SQL, op5_quality
from sitewise.llm.sharding import op10_sharding
from sitewise.llm.simhash import op7_simhash
from sitewise.llm.suffixes import op1_suffix_dedup
from sitewise.llm.toxicity import op2_toxicity
from sitewise.llm.warc import OP3_SQL, op3_warc
from sitewise.llm.whitening import op12_whitening

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_warc": op3_warc,
    "op4_chat": op4_chat,
    "op5_quality": op5_quality,
    "op6_decontaminate": op6_decontaminate,
    "op7_simhash": op7_simhash,
    "op8_pii": op8_pii,
    "op9_packing": op9_packing,
    "op10_sharding": op10_sharding,
    "op11_fim": op11_fim,
    "op12_whitening": op12_whitening,
    "op13_lines": op13_lines,
}
SQL = {"op3_warc": OP3_SQL, "op4_chat": OP4_SQL, "op5_quality": OP5_SQL, "op11_fim": OP11_SQL, "op13_lines": OP13_SQL}
