"""locusframe.functions"""
