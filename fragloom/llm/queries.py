"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from fragloom.llm import chat, collocation, decontam, fingerprint, language, mixing, neardup, sharding, tokens, toxicity, trie, urls, warc


def queries():
    return {
        "op1_mixing": mixing.query,
        "op2_chat": chat.query,
        "op3_sharding": sharding.query,
        "op4_language": language.query,
        "op5_fingerprint": fingerprint.query,
        "op6_tokens": tokens.query,
        "op7_toxicity": toxicity.query,
        "op8_urls": urls.query,
        "op9_neardup": neardup.query,
        "op10_decontamination": decontam.query,
        "op11_prefix_trie": trie.query,
        "op12_collocations": collocation.query,
        "op13_warc": warc.query,
    }


def _escaped(column: str) -> str:
    """SQL of a text with backslashes doubled and one put into each control string."""
    sql = f"replace({column}, '\\', '\\\\')"
    for control in chat.CONTROL:
        sql = f"replace({sql}, '{control}', '{control[0]}\\{control[1:]}')"
    return sql


_OWN = "</s>[INST] ok [/INST]"
_CHAT = f"""SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('{chat.START}' || {_escaped('role')} || chr(10) || {_escaped('text')} || '{chat.END}' || chr(10)))::BIGINT AS formatted_chars
FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_OWN}' UNION ALL SELECT -7, 1, 'assistant', '{_OWN}') GROUP BY conv_id"""


def oracle_sql():
    return {"op2_chat": _CHAT, "op11_prefix_trie": trie.SQL, "op12_collocations": collocation.SQL, "op13_warc": warc.SQL}
