"""locusframe.streaming"""
