"""Fixed values. Results depend on them, so they are stated as they are."""

# --- fixed values: characters a Python str.strip() removes -------------------
PY_WHITESPACE = "".join(
    chr(c)
    for c in [
        *range(9, 14),
        *range(28, 33),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    ]
)

# --- fixed values: prompts ---------------------------------------------------
SYSTEM_PROMPT = """
Respond in the following format:
<reasoning>
...
</reasoning>
<answer>
...
</answer>
"""

RISK_SYSTEM_PROMPT = """You are a risk assessment AI.
Respond in XML format, giving your chain-of-thought reasoning first.
YOU MUST ALWAYS RETURN A VALID XML DOCUMENT.
The XML must contain exactly one element inside <answer>:
<risk_level>  one of: [low risk, moderate risk, high risk, very high risk]

Example:
<reasoning>
[Your analysis]
</reasoning>
<answer>
<risk_level>[low risk|moderate risk|high risk|very high risk]</risk_level>
</answer>"""

# --- fixed values: markers ---------------------------------------------------
ANSWER_OPEN = "<answer>"
ANSWER_CLOSE = "</answer>"
HASH_MARK = "####"
INST_CLOSE = "[/INST]"
STRICT_FORMAT = r"^<reasoning>\n.*?\n</reasoning>\n<answer>\n.*?\n</answer>\n$"

# --- fixed values: rewards ---------------------------------------------------
CORRECT_REWARD = 2.0
FORMAT_REWARD = 0.5
TARGET_LENGTH = 20

# --- fixed values: bands -----------------------------------------------------
BAND_ORDINALS = {
    "returns": {"bad": 0, "neutral": 1, "good": 2},
    "volatility": {"low": 0, "medium": 1, "high": 2},
}
BAND_DISTRIBUTIONS = {  # band -> (mean, standard deviation)
    "bad": (-0.15, 0.20),
    "neutral": (0.05, 0.15),
    "good": (0.20, 0.25),
}
RISK_LEVELS = ["low risk", "moderate risk", "high risk", "very high risk"]

# --- fixed values: workload defaults -----------------------------------------
CONFIDENCE = 0.95
DRAWS_PER_PREDICTION = 1000
BENCHMARK_ROWS = 100
EVAL_EVERY = 100
EVAL_SAMPLES = 32
MAX_PROMPT_TOKENS = 2048
TEST_SIZE = 0.2
