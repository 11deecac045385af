"""Values of the warehouse's rules that are fixed, since stored results depend on them."""

# Topic segmentation.
SIMILARITY_THRESHOLD = 0.3
MIN_CHUNK_MESSAGES = 3
MAX_CHUNK_MESSAGES = 50
MAX_CHUNK_CHARS = 20000
# Lengths of texts before model calls, and the mark of a cut.
MAX_TEXT_CHARS = 24000
PIECE_CHARS = 6000
PIECE_OVERLAP = 300
SUMMARY_CHARS = 12000
CHUNK_VECTOR_CHARS = 6000
MAX_RECORD_CHARS = 100000
CUT_MARK = "... [truncated]"
# Fixed value: the name space of derived conversation ids.
ID_NAMESPACE = "a1b2c3d4-e5f6-7890-abcd-ef1234567890"
# An embedded blob in a transcript, and what stands for it.
BLOB_PATTERN = r'"data"\s*:\s*"[A-Za-z0-9+/=\s\\]{1000,}"'
BLOB_MARK = '"data": "[base64 removed]"'
# Content types by suffix.
CONTENT_TYPES = {".png": "image/png", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".gif": "image/gif", ".webp": "image/webp", ".pdf": "application/pdf", ".csv": "text/csv", ".json": "application/json", ".txt": "text/plain"}
DEFAULT_CONTENT_TYPE = "application/octet-stream"
