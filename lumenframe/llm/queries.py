"""Registered queries of the training-data operators, and SQL for those that have it."""

from __future__ import annotations

from .digest import op10_fingerprints
from .htmlextract import op8_html
from .media import op5_media
from .minhash import OP4_SQL, op4_minhash
from .mixing import OP1_SQL, op1_mixing
from .packing import op6_packing
from .pii import op9_pii
from .sharding import op7_sharding
from .toxicity import op2_toxicity
from .urlfilter import OP3_SQL, op3_url_filter

QUERIES = {f.__name__: f for f in (op1_mixing, op2_toxicity, op3_url_filter, op4_minhash, op5_media, op6_packing, op7_sharding, op8_html, op9_pii, op10_fingerprints)}
ORACLE_SQL = {"op1_mixing": OP1_SQL, "op3_url_filter": OP3_SQL, "op4_minhash": OP4_SQL}
