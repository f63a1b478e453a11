"""Texts, names and numbers that must match for right results."""

# Prompt texts.
SYSTEM_TEMPLATE = (
    "You are a helpful assistant with access to the following functions. "
    "Use them if required.\n\n"
    "If you call a function, respond with ONLY a JSON object of the form "
    '{"name": "<function name>", "arguments": {...}}, and nothing else -- '
    "no extra text, no markdown formatting.\n\n"
    "Available functions:\n{tools_json}"
)
TOOLS_SLOT = "{tools_json}"
FUNCTION_RESPONSE_PREFIX = "FUNCTION RESPONSE: "

# Roles of the raw chat corpus and the chat roles they become.
DIALOGUE_ROLES = {"human": "user", "gpt": "assistant"}
GENERAL_CHAT_ROLES = {"human": "user", "gpt": "assistant", "system": "system"}
PREP_ROLES = {"human": "user", "gpt": "assistant", "function_call": "assistant"}
CAPTURE_ROLES = {
    "human": "user",
    "gpt": "assistant",
    "function_call": "assistant",
    "function_response": "tool",
    "system": "system",
}

# Labels of kept completions.
FUNCTION_CALL = "function_call"
CLARIFY_OR_DECLINE = "clarify_or_decline"

# Sampling and splitting.
SPLIT_SEED = 3407
SAMPLE_ROWS = 3000
TEST_SHARE = 0.08
MEDIUM_ROWS = 300

# Token capture.
MAX_SEQUENCE = 768
MAX_TRAIN_TOKENS = 512
TOP_K = 64
IGNORE_LABEL = -100
ROWS_PER_FILE = 5000
MAX_VOCABULARY = 1_000_000

# Generation.
GENERATION_BATCH = 4

# Loss sweep and run bookkeeping.
SWEEP_TEMPERATURES = (1.0, 2.0, 4.0)
SWEEP_ALPHAS = (0.0, 0.5, 0.9)
SAVE_EVERY_STEPS = 10
SAVES_KEPT = 3
