"""The registered queries of this subpackage and their DuckDB SQL."""

from imlens.llm import op10_decontam as decontam
from imlens.llm import op11_repair as repair
from imlens.llm import op12_align as align
from imlens.llm import op13_shards as shards
from imlens.llm import op2_jaccard as jaccard
from imlens.llm import op3_topk as topk
from imlens.llm import op4_quotes as quotes
from imlens.llm import op5_mixing as mixing
from imlens.llm import op6_suffix as suffix
from imlens.llm import op7_quality as quality
from imlens.llm import op8_brown as brown
from imlens.llm import op9_warc as warc
from imlens.llm.op1_rans import op1_rans

QUERIES = {
    "op1_rans": op1_rans,
    "op2_jaccard": jaccard.op2_jaccard,
    "op3_topk": topk.op3_topk,
    "op4_quotes": quotes.op4_quotes,
    "op5_mixing": mixing.op5_mixing,
    "op6_suffix": suffix.op6_suffix,
    "op7_quality": quality.op7_quality,
    "op8_brown": brown.op8_brown,
    "op9_warc": warc.op9_warc,
    "op10_decontam": decontam.op10_decontam,
    "op11_repair": repair.op11_repair,
    "op12_align": align.op12_align,
    "op13_shards": shards.op13_shards,
}

ORACLE_SQL: dict[str, str] = {
    "op3_topk": topk.ORACLE,
    "op4_quotes": quotes.ORACLE,
    "op5_mixing": mixing.ORACLE,
    "op9_warc": warc.ORACLE,
    "op13_shards": shards.ORACLE,
}
