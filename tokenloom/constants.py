"""Fixed values of the tokenizer format. They decide ids and texts, so they must not change."""

# Reserved tokens; the position in the list is the id.
SPECIAL_TOKENS = ["<s>", "</s>", "<pad>", "<unk>", "<mask>"]
BOS, EOS, PAD, UNK, MASK = range(5)

# Label value that the loss ignores.
IGNORE = -100

# Pre-token pattern of byte-level BPE. Java needs (?U) for Unicode classes, and tries alternatives one by one, so the endings share one.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
JAVA_WORD_PATTERN = "(?U)'(?:s|t|re|ve|m|ll|d)" + WORD_PATTERN.removeprefix("'s|'t|'re|'ve|'m|'ll|'d")

# Chat markers.
USER_OPEN = "<s>user\n"
USER_CLOSE = "</s>\n<s>assistant\n"
ASSISTANT_CLOSE = "</s>\n"

# Chat template as stored with the tokenizer settings (Jinja text, never run here).
CHAT_TEMPLATE = "{% if messages[0]['role'] == 'system' %}{% set system_message = messages[0]['content'] %}{% endif %}{% if system_message is defined %}{{ system_message }}{% endif %}{% for message in messages %}{% set content = message['content'] %}{% if message['role'] == 'user' %}{{ '<s>user\\n' + content + '</s>\\n<s>assistant\\n' }}{% elif message['role'] == 'assistant' %}{{ content + '</s>' + '\\n' }}{% endif %}{% endfor %}"

# Published sizes of the three jobs.
VOCAB_SIZE = 32000
MIN_FREQUENCY = 5
CORPUS_ROWS = 1_200_000
CORPUS_CHUNKS = 6
HEAD_PERCENT = 50
TOKENIZER_FRACTION = 0.1
VALIDATION_FRACTION = 0.05
MAX_SEQ_LEN = 512
BATCH_ROWS = 32
ACCUMULATION = 8
MAX_STEPS = 37500
SEED = 17


def _stand_ins() -> list[str]:
    """Printable character for each byte: itself where printable, else 256, 257, ... in byte order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


STAND_INS = _stand_ins()
# Bytes follow the reserved tokens in the code-point order of their stand-ins.
BYTE_IDS = [len(SPECIAL_TOKENS) + sorted(STAND_INS).index(c) for c in STAND_INS]
FIRST_MERGE_ID = len(SPECIAL_TOKENS) + 256
