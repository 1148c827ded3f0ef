"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from . import archives, clusters, lexical
from .archives import op13_warc_index
from .clusters import op11_equal_average
from .decontamination import op2_templates
from .language import op8_bloom_filters
from .lexical import op12_dense_blocks
from .mixing import op6_entropy_balancing
from .neardup import op10_superminhash
from .quality import op5_divergence
from .repeats import op1_previous_factors
from .sharding import op7_external_shuffle
from .tokens import op4_prefix_tokens
from .toxicity import op3_naive_bayes_linear
from .urls import op9_url_trees

OPERATORS = (
    op1_previous_factors, op2_templates, op3_naive_bayes_linear, op4_prefix_tokens, op5_divergence, op6_entropy_balancing,
    op7_external_shuffle, op8_bloom_filters, op9_url_trees, op10_superminhash, op11_equal_average,
    op12_dense_blocks, op13_warc_index,
)
QUERIES = {operator.__name__: operator for operator in OPERATORS}
ORACLES: dict[str, str] = {"op11_equal_average": clusters.SQL, "op12_dense_blocks": lexical.SQL, "op13_warc_index": archives.SQL}
