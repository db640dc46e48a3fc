"""The corpus operators as registered queries: name -> function of (spark, sf_dir), and the SQL of those that SQL can
express. secrets_base and licenses_base are the columns of op2 and op5 that SQL can check."""

from __future__ import annotations

from landloom.llm import (
    alignment, decontam, embeddings, licenses, lines, minhash, mixing, packing, search, secrets, substrings, suffixes, toxicity
)

QUERIES = {
    "op1_mixing": mixing.op1,
    "op2_secrets": secrets.op2,
    "op3_embeddings": embeddings.op3,
    "op4_suffix_dedup": suffixes.op4,
    "op5_licenses": licenses.op5,
    "op6_decontamination": decontam.op6,
    "op7_line_dedup": lines.op7,
    "op8_minhash_dedup": minhash.op8,
    "op9_substring_dedup": substrings.op9,
    "op10_toxicity": toxicity.op10,
    "op11_search": search.op11,
    "op12_packing": packing.op12,
    "op13_alignment": alignment.op13,
    "secrets_base": secrets.secrets_base,
    "licenses_base": licenses.licenses_base,
}

ORACLE_SQL = {
    "op1_mixing": mixing.SQL,
    "op3_embeddings": embeddings.SQL,
    "op4_suffix_dedup": suffixes.SQL,
    "op7_line_dedup": lines.SQL,
    "op8_minhash_dedup": minhash.SQL,
    "op9_substring_dedup": substrings.SQL,
    "op11_search": search.SQL,
    "secrets_base": secrets.BASE_SQL,
    "licenses_base": licenses.BASE_SQL,
}
