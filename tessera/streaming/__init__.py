"""tessera.streaming"""
