"""Conversation templates.

FIXED VALUES: the template strings below must equal the published chat formats
for rendered prompts to be right. They are listed in registration order; a name
registered twice keeps its later entry (``deepseek``). Fields: name,
system_prompt, roles, prompt (with ``{query}``), sep, stop_str.
"""

_STOP = "</s>"

# fmt: off
REGISTRATIONS = [
    ("vicuna",
     "A chat between a curious user and an artificial intelligence assistant. "
     "The assistant gives helpful, detailed, and polite answers to the user's questions.",
     ("USER", "ASSISTANT"), "USER: {query} ASSISTANT:", "</s>", _STOP),
    ("base", "", ("USER", "ASSISTANT"), "{query}", "</s>", _STOP),
    ("alpaca",
     "Below is an instruction that describes a task. "
     "Write a response that appropriately completes the request.",
     ("### Instruction", "### Response"), "### Instruction:\n{query}\n\n### Response:\n", "\n\n", _STOP),
    ("baichuan", "", ("<reserved_102>", "<reserved_103>"), "<reserved_102>{query}<reserved_103>", "</s>", _STOP),
    ("baichuan2", "", ("<reserved_106>", "<reserved_107>"), "<reserved_106>{query}<reserved_107>", "</s>", _STOP),
    ("ziya", "", ("<human>", "<bot>"), "<human>:{query}\n<bot>:", "\n", _STOP),
    ("linly", "", ("User", "Bot"), "User: {query}\nBot: ", "\n", _STOP),
    ("chatglm", "", ("问", "答"), "问：{query}\n答：", "\n", _STOP),
    ("chatglm2", "", ("问", "答"), "问：{query}\n\n答：", "\n\n", _STOP),
    ("chatglm3", "", ("<|user|>", "<|assistant|>"), "<|user|>\n{query}<|assistant|>", "\n", "<|user|>"),
    ("phoenix",
     "A chat between a curious human and an artificial intelligence assistant. "
     "The assistant gives helpful, detailed, and polite answers to the human's questions.\n\n",
     ("Human", "Assistant"), "Human: <s>{query}</s>Assistant: ", "</s>", _STOP),
    ("belle", "", ("Human", "Belle"), "Human: {query}\n\nBelle: ", "\n\n", _STOP),
    ("aquila",
     "A chat between a curious human and an artificial intelligence assistant. "
     "The assistant gives helpful, detailed, and polite answers to the human's questions.",
     ("Human", "Assistant"), "Human: {query}###Assistant:", "###", _STOP),
    ("intern", "", ("<|User|>", "<|Bot|>"), "<|User|>:{query}<eoh>\n<|Bot|>:", "<eoa>\n", "<eoa>"),
    ("intern2",
     "<|im_start|>system\nYou are an AI assistant whose name is InternLM (书生·浦语).\n<|im_end|>\n",
     ("user", "assistant"), "<|im_start|>user\n{query}<|im_end|>\n<|im_start|>assistant\n",
     "<|im_end|>\n", "<|im_end|>"),
    ("starchat", "<system>\n", ("<|user|>", "<|assistant|>"),
     "<|user|>\n{query}<|end|>\n<|assistant|>\n", "<|end|>\n", "<|end|>"),
    ("llama2",
     "<<SYS>>\nYou are a helpful, respectful and honest assistant. "
     "Always answer as helpfully as possible, while being safe. "
     "Your answers should not include any harmful, unethical, racist, sexist, "
     "toxic, dangerous, or illegal content. "
     "Please ensure that your responses are socially unbiased and positive in nature.\n\n"
     "If a question does not make any sense, or is not factually coherent, "
     "explain why instead of answering something not correct. "
     "If you don't know the answer to a question, please don't share false information.\n<</SYS>>\n\n",
     ("[INST]", "[/INST]"), "[INST] {query} [/INST]", "</s>", _STOP),
    ("llama3",
     "<|start_header_id|>system<|end_header_id|>\n\nYou are a helpful, excellent and smart assistant.",
     ("user", "assistant"),
     "<|start_header_id|>user<|end_header_id|>\n\n{query}<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n",
     "<|eot_id|>", "<|eot_id|>"),
    ("llama2-zh",
     "[INST] <<SYS>>\nYou are a helpful assistant. 你是一个乐于助人的助手。\n<</SYS>>\n\n [/INST]",
     ("[INST]", "[/INST]"), "[INST] {query} [/INST]", "</s>", _STOP),
    ("mistral", "", ("[INST]", "[/INST]"), "[INST] {query} [/INST]", "</s>", _STOP),
    ("xverse", "", ("Human", "Assistant"), "Human: {query}\n\nAssistant: ", "</s>", _STOP),
    ("chatml", "You are a helpful assistant.", ("user", "assistant"),
     "<|im_start|>user\n{query}<|im_end|>\n<|im_start|>assistant\n", "<|im_end|>\n", "<|im_end|>"),
    ("deepseek", "", ("User", "Assistant"), "User: {query}\n\nAssistant:", "</s>", _STOP),
    ("deepseek3", "", ("<｜User｜>", "<｜Assistant｜>"), "<｜User｜>{query}<｜Assistant｜>", "</s>", _STOP),
    # The published format writes the placeholder with doubled braces, which would
    # render a literal "{content}" and lose the question; we place the question.
    ("deepseekcoder",
     "You are an AI programming assistant, utilizing the Deepseek Coder model, "
     "developed by Deepseek Company, and you only answer questions related to computer science. "
     "For politically sensitive questions, security and privacy issues, "
     "and other non-computer science questions, you will refuse to answer\n",
     ("### Instruction", "### Response"), "### Instruction:\n{query}\n### Response:\n", "\n", "<|EOT|>"),
    ("yi", "", ("user", "assistant"), "<|im_start|>user\n{query}<|im_end|>\n<|im_start|>assistant\n", "\n",
     "<|im_end|>"),
    ("orion", "", ("Human", "Assistant"), "Human: {query}\n\nAssistant: </s>", "</s>", _STOP),
    ("cohere", "<BOS_TOKEN>", ("User", "Assistant"),
     "<|START_OF_TURN_TOKEN|><|USER_TOKEN|>{query}<|END_OF_TURN_TOKEN|><|START_OF_TURN_TOKEN|><|CHATBOT_TOKEN|>",
     "</s>", _STOP),
    ("qwen", "<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n", ("user", "assistant"),
     "<|im_start|>user\n{query}<|im_end|>\n<|im_start|>assistant\n", "\n", "<|im_end|>"),
    ("deepseek", "<BOS_TOKEN>", ("User", "Assistant"),
     "<|START_OF_TURN_TOKEN|><|USER_TOKEN|>{query}<|END_OF_TURN_TOKEN|><|START_OF_TURN_TOKEN|><|CHATBOT_TOKEN|>",
     "</s>", _STOP),
]
# fmt: on
