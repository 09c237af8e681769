"""Declared schemas; none is inferred when data is read."""

BLOCK = "struct<index: int, category: string, bbox: array<double>, text_format: string, text: string>"
PAGE_BLOCK = "struct<index: int, page: int, page_index: int, category: string, bbox: array<double>, text_format: string, text: string>"
PAGE_RESULT = f"doc_id string, page int, image string, status string, error string, block_count int, blocks array<{PAGE_BLOCK}>"
DETECTION = "video string, frame_index int, hand string, bbox_xyxy array<float>, score float, track_id int"
TRACK = "video string, hand string, segment_id long, frame_index int, bbox_xyxy array<double>, detected boolean, score double"
CHUNK = "video string, hand string, segment_id long, chunk_id long, frame_indices array<int>, boxes array<array<double>>, valid_count int"
SCORE = "image_id long, pos int, text string, cosine_similarity double, consistency_score double"
SEGMENT = "struct<id: int, start: double, end: double, text: string, words: array<struct<start: double, end: double, word: string>>>"
ASR = f"source string, model string, duration_seconds double, audio_present boolean, language string, text string, segments array<{SEGMENT}>"
