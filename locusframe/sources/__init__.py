"""locusframe.sources"""
