"""locusframe.plans"""
