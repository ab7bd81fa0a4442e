"""Special tokens, request templates and default parameters.

They have to keep these exact values for results to stay comparable, so they are
stated here once, as plain text, and used everywhere else by name.
"""

# Special tokens, in id order. Ids 0..5 are reserved for them.
PAD = "[PAD]"
CLS = "[CLS]"
SEP = "[SEP]"
BOS = "[BOS]"
EOS = "<|endoftext|>"
UNK = "[UNK]"
SPECIAL_TOKENS = (PAD, CLS, SEP, BOS, EOS, UNK)
PAD_ID = 0
UNK_ID = 5

# Label of a position that carries no loss.
IGNORE_LABEL = -100

# Parameters.
MAX_LENGTH = 512
MAX_NEW_TOKENS = 128
CONTEXT_LIMIT = 1024
BATCH_SIZE = 4
MARGIN = 1.0
CLIP_EPSILON = 0.2
KL_COEFFICIENT = 0.005
VALUE_COEFFICIENT = 0.05
STD_EPSILON = 1e-8
MASK_EPSILON = 1e-9
TEMPERATURE = 0.8
TOP_K = 50
SEED = 42
PROMPT_COLUMN = "Prompts"
EMPTY_ANSWER = "The model produced an empty response."

# Text of the two judge requests.
PREFERENCE_SYSTEM = "You are an impartial response-quality evaluator."
RATING_SYSTEM = "You are a strict response-quality evaluator."
PREFERENCE_CLOSING = "Choose the better answer. Respond with exactly A or B."
RATING_CLOSING = "Score the answer from 1 to 5. Respond with only a number."

# Every code point that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
