"""wavelake: PySpark-native analytics for audio-separation requests and their reports."""
