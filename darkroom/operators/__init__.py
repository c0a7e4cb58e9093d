"""darkroom.operators"""
