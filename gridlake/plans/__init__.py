"""Whole jobs: conversion of a run into a store, and the store itself."""
