"""Word lists and lookup tables.

Fixed values: results depend on these exact entries.
"""

KOREAN_POSITIVE = (
    "좋다", "좋은", "좋음", "훌륭", "최고", "멋진", "대단", "완벽", "성공", "사랑", "감사",
    "행복", "기쁘다", "기쁜", "만족", "우수", "탁월", "뛰어난", "괜찮", "잘했", "칭찬",
    "추천", "최신", "신선", "재미있", "흥미롭", "놀라운", "환상적", "즐거운", "유용한",
)

KOREAN_NEGATIVE = (
    "나쁘다", "나쁜", "나쁨", "최악", "별로", "실망", "화나", "짜증", "못생긴", "싫어", "싫다",
    "문제", "고장", "버그", "오류", "에러", "실패", "망함", "끔찍", "답답", "속상",
    "걱정", "불안", "스트레스", "힘들", "어렵", "짜증나", "귀찮", "불편", "복잡",
)

ENGLISH_POSITIVE = (
    "good", "great", "excellent", "amazing", "awesome", "fantastic", "wonderful",
    "love", "like", "best", "perfect", "nice", "happy", "glad", "excited",
    "thank", "thanks", "appreciate", "brilliant", "outstanding", "incredible",
    "beautiful", "successful", "win", "won", "victory", "achieve", "cool",
)

ENGLISH_NEGATIVE = (
    "bad", "terrible", "awful", "horrible", "hate", "dislike", "worst", "suck",
    "fail", "failed", "failure", "broken", "wrong", "error", "problem", "issue",
    "sad", "angry", "mad", "disappointed", "frustrating", "annoying", "stupid",
    "useless", "garbage", "trash", "waste", "disaster", "nightmare",
)

# "?" and "looking for" are no word tokens; "?" is tested on the text itself.
NEUTRAL_CUES = (
    "what", "how", "when", "where", "who", "why", "?", "help", "question",
    "anyone", "does", "can", "could", "would", "should", "looking for",
)

# Words whose presence makes an otherwise undecided text negative.
ERROR_WORDS = ("error", "problem", "issue", "broken")

# Short mixed list of the last-resort scorer.
MIXED_POSITIVE = (
    "good", "great", "excellent", "amazing", "wonderful", "love", "best", "perfect",
    "awesome", "좋", "최고", "훌륭", "멋진", "완벽",
)
MIXED_NEGATIVE = (
    "bad", "terrible", "awful", "worst", "hate", "horrible", "disgusting",
    "나쁘", "최악", "끔찍", "혐오",
)

# Lexicon per language; languages not listed use the "en" entry. The token
# scorers take a caller's table of the same shape as `lexicons`.
LEXICONS = {
    "ko": (KOREAN_POSITIVE, KOREAN_NEGATIVE),
    "en": (ENGLISH_POSITIVE, ENGLISH_NEGATIVE),
}

STOPWORDS = (
    "the", "a", "an", "is", "it", "for", "and", "in", "of", "to", "on", "with", "as", "by",
    "from", "at", "that", "this", "be", "have", "has", "had", "do", "does", "did", "not", "no",
    "yes", "i", "you", "he", "she", "it", "we", "they", "me", "him", "her", "us", "them", "my",
    "your", "his", "her", "its", "our", "their", "this", "that", "these", "those", "am", "are",
    "was", "were", "been", "being", "can", "could", "will", "would", "should", "may", "might",
    "must", "about", "above", "after", "again", "against", "all", "any", "because", "before",
    "being", "below", "between", "both", "but", "by", "down", "during", "each", "few", "for",
    "from", "further", "here", "how", "if", "into", "just", "more", "most", "now", "off", "once",
    "only", "or", "other", "our", "out", "over", "own", "same", "she", "so", "some", "such",
    "than", "that", "then", "there", "these", "they", "this", "those", "through", "to", "too",
    "under", "until", "up", "very", "was", "we", "what", "when", "where", "which", "while",
    "who", "whom", "why", "with", "you", "your",
)

# First match in this order names the marker.
SENSITIVE_TERMS = ("password", "secret", "key", "token", "credential")
SENSITIVE_MARKER = "[로그에 민감한 정보 포함됨 - %s]"

ALERT_SEVERITIES = ("HIGH", "CRITICAL")
ALERT_FORMAT = "🚨 ALERT: %s error in %s"

RECOVERY_STRATEGIES = {
    "ConnectionError": "RETRY",
    "TimeoutError": "RETRY",
    "HTTPError": "FALLBACK",
    "OpenAIError": "FALLBACK",
    "HuggingFaceError": "FALLBACK",
    "DataProcessingError": "FALLBACK",
    "ValidationError": "RETRY",
    "OutOfMemoryError": "RESTART",
    "DiskSpaceError": "MANUAL",
    "SparkError": "RESTART",
    "HDFSError": "RETRY",
}
DEFAULT_STRATEGY = "MANUAL"

LANGUAGES = ("ko", "ar", "zh", "ja", "ru", "th", "en")
LABELS = ("POSITIVE", "NEGATIVE", "NEUTRAL")
