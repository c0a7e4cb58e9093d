"""darkroom.streaming"""
