"""Registered queries of the operators, and SQL where it can express them."""

from . import chat, epsgrid, htmltext, linededup, negatives, omh, packing, pieces, quality, secrets, sharding, warc, whiten

QUERIES = {
    "op1_merge_dropout": pieces.op1,
    "op2_packing": packing.op2,
    "op3_line_dedup": linededup.op3,
    "op4_embedding_links": epsgrid.op4,
    "op5_chat_format": chat.op5,
    "op6_html_text": htmltext.op6,
    "op7_warc": warc.op7,
    "op8_minhash_dedup": omh.op8,
    "op9_sharding": sharding.op9,
    "op10_quality_rules": quality.op10,
    "op11_secret_scan": secrets.op11,
    "op12_whitening": whiten.op12,
    "op13_hard_negatives": negatives.op13,
}

ORACLE_SQL = {
    "op3_line_dedup": linededup.OP3_SQL,
    "op4_embedding_links": epsgrid.OP4_SQL,
    "op5_chat_format": chat.OP5_SQL,
    "op13_hard_negatives": negatives.OP13_SQL,
}
