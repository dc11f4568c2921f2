"""Chat shapes: array and table form against plain strings."""

import pytest

from tidewrack.operators import chat_shapes as C

CHATS = {
    1: [("system", " be short "), ("user", "Hi "), ("assistant", "Hello"), ("user", "Bye")],
    2: [("user", "only")],
    3: [("system", "no user here")],
    4: [("user", "a"), ("system", "later"), ("assistant", None)],
    5: [("system", "s"), ("assistant", "first"), ("user", "then"), ("tool", "odd")],
}
INST = {
    1: "<s>[INST] <<SYS>>\nbe short\n<</SYS>>\n\nHi [/INST] Hello </s><s>[INST] Bye [/INST]",
    2: "<s>[INST] only [/INST]",
    3: "<s>[INST] <<SYS>>\nno user here\n<</SYS>> [/INST]",
    4: "<s>[INST] a [/INST]<s>[INST] <<SYS>>\nlater\n<</SYS>> [/INST]  </s>",
    5: " first </s><s>[INST] <<SYS>>\ns\n<</SYS>>\n\nthen [/INST]<s>[INST] odd [/INST]",
}
CHATML = {k: "".join(f"<|im_start|>{r if r != 'tool' else 'user'}\n{t or ''}<|im_end|>\n" for r, t in m) + "<|im_start|>assistant\n" for k, m in CHATS.items()}
TURNS = {
    1: "<bos><start_of_turn>user\nbe short\n\nHi<end_of_turn>\n<start_of_turn>model\nHello<end_of_turn>\n<start_of_turn>user\nBye<end_of_turn>\n<start_of_turn>model\n",
    2: "<bos><start_of_turn>user\nonly<end_of_turn>\n<start_of_turn>model\n",
}


@pytest.mark.parametrize("name, want", [("inst", INST), ("chatml", CHATML), ("turns", TURNS)])
def test_shapes(spark, name, want):
    shape = C.SHAPES[name]
    turns = spark.createDataFrame([(k, i, r, t) for k, m in CHATS.items() for i, (r, t) in enumerate(m)], "conv_id long, turn int, role string, text string")
    arrays = spark.createDataFrame([(k, m) for k, m in CHATS.items()], "k long, messages array<struct<role: string, content: string>>")
    table = {r.conv_id: r.chat for r in C.chats(turns.repartition(3), shape).collect()}
    column = {r.k: r.chat for r in arrays.select("k", C.render(arrays.messages, shape).alias("chat")).collect()}
    assert table == column and {k: table[k] for k in want} == want
