"""locusframe.operators"""
