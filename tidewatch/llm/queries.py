"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import corpus_pipeline
from tidewatch.llm.audit import OP13_SQL, op13_audit
from tidewatch.llm.bitsliced import OP6_SQL, op6_bitsliced
from tidewatch.llm.chains import op2_chains
from tidewatch.llm.hosts import OP10_SQL, op10_hosts
from tidewatch.llm.lines import OP4_SQL, op4_lines
from tidewatch.llm.lm import op7_lm
from tidewatch.llm.mixing import OP3_SQL, op3_mixing
from tidewatch.llm.quality import op9_quality
from tidewatch.llm.ranked import OP11_SQL, op11_ranked
from tidewatch.llm.sentencepiece import op1_sentencepiece
from tidewatch.llm.sharding import OP12_SQL, op12_sharding
from tidewatch.llm.simhash import op8_simhash
from tidewatch.llm.urls import OP5_SQL, op5_urls

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_sentencepiece": op1_sentencepiece,
    "op2_chains": op2_chains,
    "op3_mixing": op3_mixing,
    "op4_lines": op4_lines,
    "op5_urls": op5_urls,
    "op6_bitsliced": op6_bitsliced,
    "op7_lm": op7_lm,
    "op8_simhash": op8_simhash,
    "op9_quality": op9_quality,
    "op10_hosts": op10_hosts,
    "op11_ranked": op11_ranked,
    "op12_sharding": op12_sharding,
    "op13_audit": op13_audit,
}

ORACLES: dict[str, str] = {
    "op3_mixing": OP3_SQL,
    "op4_lines": OP4_SQL,
    "op5_urls": OP5_SQL,
    "op6_bitsliced": OP6_SQL,
    "op10_hosts": OP10_SQL,
    "op11_ranked": OP11_SQL,
    "op12_sharding": OP12_SQL,
    "op13_audit": OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
